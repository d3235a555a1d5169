"""Several outlines of one book: clusters, conflicts, votes, authority and adoption lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Headings of appendices and tables.
APPENDIX = r"(索引|別表|凡例|書式|資料編?|付録|附録|参考文献|奥付)"


def clusters(nodes: DataFrame, book: str, source: str, key: str) -> DataFrame:
    """Headings of one key in a book: matched where two sources or more have it, else orphan.

    Rows without a key are counted in ``unkeyed`` of :func:`accounting`, never lost silently.
    """
    return nodes.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(book, key).agg(
        F.count_distinct(source).alias("n_sources"), F.count(F.lit(1)).alias("n_nodes")
    ).withColumn("kind", F.when(F.col("n_sources") >= 2, "matched").otherwise("orphan"))


def accounting(nodes: DataFrame, book: str, source: str, key: str) -> DataFrame:
    """Per book: all rows, those without a key, matched and orphan ones, and whether they add up."""
    total = nodes.groupBy(book).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(F.col(key), F.lit("")) == "").alias("unkeyed"))
    kinds = clusters(nodes, book, source, key).groupBy(book).agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "matched", F.col("n_nodes"))), F.lit(0)).alias("matched"), F.coalesce(F.sum(F.when(F.col("kind") == "orphan", F.col("n_nodes"))), F.lit(0)).alias("orphan")
    )
    out = total.join(kinds, book, "left").na.fill(0, ["matched", "orphan"])
    return out.withColumn("accounted", F.col("total") == F.col("unkeyed") + F.col("matched") + F.col("orphan"))


def votes(nodes: DataFrame, book: str, key: str, origin: str, least: int = 3) -> DataFrame:
    """Distinct declared origins of each heading; ``least`` of them are a consensus. Counted exactly."""
    return nodes.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(book, key).agg(F.count_distinct(origin).alias("votes")).withColumn("consensus", F.col("votes") >= least)


def conflicts(nodes: DataFrame, *, book: str, source: str, title: str, key: str, depth: str, scheme: str, sources: DataFrame | None = None, identity: DataFrame | None = None, ratio: float = 3.0, appendix_min: int = 2) -> DataFrame:
    """``(book, pattern, severity, resolved, source)``: eight detectors over a book's outlines, as one union.

    Coverage apart by ``ratio``; a source that begins below the top; appendix words at the top beside a
    body; headings repeated within a source (legitimate, resolved); numbering styles that differ between
    sources; headings that only one source has. With ``sources`` (book, source, page_basis) page bases that
    differ, with ``identity`` (book, status) sources that are not known to be one manifestation: structural
    if they seem to be several, else moderate.
    """
    keyed = nodes.where(F.coalesce(F.col(key), F.lit("")) != "")
    per = keyed.groupBy(book, source).agg(
        F.count(F.lit(1)).alias("n"), F.min(depth).alias("lo"), F.count_if((F.col(depth) == 1) & F.col(title).rlike(APPENDIX)).alias("bad"), F.bool_or(F.col(depth) >= 2).alias("body"), F.array_sort(F.collect_set(scheme)).alias("schemes")
    )
    row = lambda df, pattern, severity, resolved, who=None: df.select(book, F.lit(pattern).alias("pattern"), F.lit(severity).alias("severity"), F.lit(resolved).alias("resolved"), (F.col(who) if who else F.lit("")).alias("source"))
    whole = per.groupBy(book).agg(
        F.count(F.lit(1)).alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.count_if(F.size("schemes") > 0).alias("with_scheme"), F.size(F.array_distinct(F.flatten(F.collect_list("schemes")))).alias("styles")
    )
    repeated = keyed.groupBy(book, source, key).count().where("count > 1").select(book, source).distinct()
    lone = clusters(nodes, book, source, key).where("kind = 'orphan'").select(book).distinct()
    found = [
        row(whole.where((F.col("k") >= 2) & (F.col("hi") / F.col("lo") >= ratio)), "coverage_mismatch", "major", False),
        row(per.where("lo > 1"), "partial_toc_source", "moderate", False, source),
        row(per.where((F.col("bad") >= appendix_min) & F.col("body")), "appendix_or_table_misclassified", "minor", False, source),
        row(repeated, "same_heading_repeated_legitimately", "info", True, source),
        row(whole.where((F.col("styles") >= 2) & (F.col("with_scheme") >= 2)), "numbering_scheme_changed", "minor", False),
        row(lone, "orphan_quarantined", "info", False),
    ]
    if sources is not None:
        bases = sources.where(F.coalesce(F.col("page_basis"), F.lit("unknown")) != "unknown").groupBy(book).agg(F.count_distinct("page_basis").alias("n"))
        found.append(row(bases.where("n >= 2"), "page_basis_mismatch", "moderate", False))
    if identity is not None:
        apart = identity.where(~F.col("status").startswith(SAME)).withColumn("severity", F.when(F.col("status").startswith("suspected"), "structural").otherwise("moderate"))
        found.append(apart.select(book, F.lit("edition_mismatch_suspected").alias("pattern"), "severity", F.lit(False).alias("resolved"), F.lit("").alias("source")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


#: how the statuses of one manifestation begin
SAME = "resolved_same"


def risk(conflict_rows: DataFrame, book: str, identity: DataFrame | None = None, accounted: DataFrame | None = None) -> DataFrame:
    """high for rows unaccounted for, an open structural conflict or an unresolved identity; medium for any open conflict, else low.

    ``identity`` (book, status) and ``accounted`` (book, accounted) name all books; without them the books with conflicts are rated.
    """
    g = conflict_rows.groupBy(book).agg(F.count_if(~F.col("resolved")).alias("unresolved"), F.bool_or((F.col("severity") == "structural") & ~F.col("resolved")).alias("structural"))
    if identity is not None:
        g = identity.select(book, "status").join(g, book, "left")
    if accounted is not None:
        g = g.join(accounted.select(book, "accounted"), book, "full_outer")
    no = F.lit(False)
    lost = F.coalesce(~F.col("accounted"), no) if accounted is not None else no
    unknown = ~F.coalesce(F.col("status").startswith(SAME), no) if identity is not None else no
    unresolved = F.coalesce("unresolved", F.lit(0))
    high = lost | F.coalesce(F.col("structural"), no) | unknown
    return g.select(book, unresolved.alias("unresolved"), F.when(high, "high").when(unresolved > 0, "medium").otherwise("low").alias("risk"))


def book_summary(conflict_rows: DataFrame, identity: DataFrame, accounted: DataFrame, sources: DataFrame, book: str) -> DataFrame:
    """One row a book: identity, conflicts by state and pattern, risk, what to do, and sources that no consensus counts."""
    by = conflict_rows.groupBy(book, "pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("resolved")).alias("open"))
    by = by.groupBy(book).agg(F.sum("n").alias("total"), F.sum("open").alias("open"), F.array_sort(F.collect_list(F.struct("pattern", "n"))).alias("by_pattern"))
    out = risk(conflict_rows, book, identity, accounted).join(identity.select(book, F.col("status").alias("edition_identity_status")), book, "left").join(accounted.select(book, "accounted"), book, "left").join(by, book, "left")
    out = out.join(sources.groupBy(book).agg(F.count_if(F.col("provenance_origin").isNull()).alias("consensus_excluded_sources")), book, "left").na.fill(0, ["total", "open", "consensus_excluded_sources"])
    todo = F.when(F.col("risk") == "low", "approve candidate").when(F.col("risk") == "medium", F.format_string("approve once %d conflicts are stamped", "open")).otherwise("do not approve; resolve identity or structure first")
    return out.select(book, "edition_identity_status", F.col("accounted").alias("all_nodes_accounted_for"), "total", "open", (F.col("total") - F.col("open")).alias("resolved"), "by_pattern", "risk", todo.alias("recommended_action"), "consensus_excluded_sources")


def pdf_reasons(meta: dict[str, object]):
    """Why an observation from a page file cannot lead: an array of reasons, empty if it qualifies.

    ``meta``: columns extraction_method, extraction_confidence, page_basis (normal form), coverage, source_sha256.
    """
    holds = lambda c: F.coalesce(c, F.lit(False))
    rules = {
        "extraction_method": meta["extraction_method"].isin("manual", "ocr", "llm", "publisher_pdf_toc"), "extraction_confidence": meta["extraction_confidence"] == "high",
        "page_basis": meta["page_basis"] != "unknown", "coverage": meta["coverage"] == "full_toc", "source_sha256": meta["source_sha256"] != "",
    }
    return F.array_compact(F.array(*[F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()]))


def resolve_authority(sources: DataFrame, identity: DataFrame, book: str, least: int = 3) -> DataFrame:
    """``(book, authority, origins)``: pdf_primary, consensus or human_review.

    A qualified page file leads if the identity is resolved and the page bases agree; else ``least`` declared origins
    (the page file not counted) are a consensus; origins that nobody declared count for nothing.
    """
    pdf = F.col("source") == "pdf"
    reasons = pdf_reasons({c: F.col(c) for c in ("extraction_method", "extraction_confidence", "page_basis", "coverage", "source_sha256")})
    known = F.when(F.coalesce(F.col("page_basis"), F.lit("unknown")) != "unknown", F.col("page_basis"))
    g = sources.groupBy(book).agg(F.bool_or(pdf & (F.size(reasons) == 0)).alias("qualified"), F.count_distinct(known).alias("bases"), F.count_distinct(F.when(~pdf, F.col("provenance_origin"))).alias("origins"))
    out = g.join(identity.select(book, F.col("status").startswith(SAME).alias("same")), book, "left")
    same = F.coalesce(F.col("same"), F.lit(False))
    return out.select(book, F.when(F.col("qualified") & same & (F.col("bases") <= 1), "pdf_primary").when(same & (F.col("origins") >= least), "consensus").otherwise("human_review").alias("authority"), "origins")


def base_source(stats: DataFrame, book: str, source: str, *, guard: float = 0.2, incumbent: str | None = None) -> DataFrame:
    """The source whose outline is the base: richest by depth, rows, pages, unless it is under ``guard`` of the largest.

    The incumbent stays where nothing is strictly richer; of equals the lesser source name wins.
    """
    top = stats.groupBy(book).agg(F.max("n_nodes").alias("_most"))
    able = stats.join(top, book).where(F.col("n_nodes") >= guard * F.col("_most"))
    kept = F.when(F.col(source) == incumbent, 1).otherwise(0) if incumbent else F.lit(0)
    order = F.struct("max_depth", "n_nodes", "page_coverage", kept.alias("kept"))
    best = able.groupBy(book).agg(F.max(order).alias("o"))
    return able.withColumn("o", order).join(best, [book, "o"]).groupBy(book).agg(F.min(source).alias("base_source"))


def lanes(nodes: DataFrame, *, snapshot: str, consensus: str, review: str, needs_offset: str) -> DataFrame:
    """Adds ``lane`` and ``lane_reason``: one lane a node.

    Without its source snapshot a node is non_adoptable; without consensus, marked for review or
    without a page offset it is pending, with every reason; else accepted.
    """
    off = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    reasons = F.array_compact(F.array(F.when(off(consensus), F.lit("non_consensus")), F.when(on(review), F.lit("review")), F.when(on(needs_offset), F.lit("needs_offset"))))
    lane = F.when(off(snapshot), "non_adoptable").when(F.size(reasons) > 0, "pending").otherwise("accepted")
    return nodes.withColumn("lane", lane).withColumn("lane_reason", F.when(off(snapshot), F.array(F.lit("source_snapshot_missing"))).otherwise(reasons))


def blockers(identity_ok, provenance_ok, consensus_ok, authority_resolved, no_hard_blocker):
    """Names of the conditions of adoption that fail; a null condition fails."""
    named = {"identity_unresolved": identity_ok, "provenance_incomplete": provenance_ok, "non_consensus_or_empty": consensus_ok, "authority_human_review": authority_resolved, "non_adoptable_nodes_present": no_hard_blocker}
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in named.items()]))


def authority(pdf_ok: str, origins: str, least: int = 3):
    """pdf_primary, else consensus of ``least`` origins, else human_review."""
    return F.when(F.coalesce(F.col(pdf_ok), F.lit(False)), "pdf_primary").when(F.col(origins) >= least, "consensus").otherwise("human_review")


def set_hash(rows: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """A hash of a group's set of tuples that no order changes: its size and two XOR sums of 60 bits, so nothing is gathered."""
    line = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in cols]))
    each = rows.select(group, line.alias("h")).distinct()
    bits = lambda at: F.bit_xor(F.conv(F.substring("h", at, 15), 16, 10).cast("long"))
    sums = each.groupBy(group).agg(F.count(F.lit(1)).alias("n"), bits(1).alias("a"), bits(16).alias("b"))
    return sums.select(group, F.sha2(F.concat_ws(":", "n", "a", "b"), 256).alias("set_hash"))
