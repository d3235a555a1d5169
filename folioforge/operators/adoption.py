"""Outlines of several sources adopted as one: identity, base, completion, lanes, envelopes, gates.

Everything is a table of nodes or of books with columns that say what was decided and why; nothing is written.

``sources``: book, source, provenance_origin, source_sha256, page_basis; ``nodes``: book, source, idx, title, k
(title key), depth, page, page_is_pdf, part_kind, author. ``priority`` lists the sources, best first; others follow by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.functions.text import page_basis, to_print_page
from folioforge.operators import concordance as C
from folioforge.operators.graph import connected_components
from folioforge.operators.ledger import violations
from folioforge.operators.outline import parents

# Kinds of parts and what becomes of them.
ATTACH_KINDS, REJECT_KINDS, REVIEW_KINDS = ["contents"], ["volume_structure"], ["mixed_small"]
#: places of a priority list that unknown sources come after
_LAST = 1_000


def rank_of(source: Column, priority: list[str]) -> Column:
    """A source's place in the priority list; what it lacks comes last."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for n, s in enumerate(priority) for x in (s, n)]), source), F.lit(_LAST)) if priority else F.lit(_LAST)


def identity_clusters(pairs: DataFrame, sources: DataFrame, with_nodes: DataFrame, priority: list[str]) -> DataFrame:
    """``(book, source, in_cluster, anchor)``: the sources of the anchor's manifestation.

    ``pairs``: book, a, b, status (of two sources). The anchor is the best source that has nodes, else the best one; its
    cluster is its connected component over pairs that are the same.
    """
    each = sources.select("book", "source").distinct().join(with_nodes.select("book", "source").distinct().withColumn("has", F.lit(True)), ["book", "source"], "left")
    order = F.struct(F.coalesce(~F.col("has"), F.lit(True)).alias("n"), rank_of(F.col("source"), priority).alias("p"), "source")
    anchors = each.groupBy("book").agg(F.min(order).alias("m")).select("book", F.col("m.source").alias("anchor"))
    name = lambda s: F.concat_ws("\x1f", "book", s)
    edges = pairs.where(F.col("status").startswith("same") | F.col("status").startswith(C.SAME)).select(name("a").alias("a"), name("b").alias("b"))
    alone = each.select(name("source").alias("a"), name("source").alias("b"))
    component = connected_components(edges.union(alone))
    tagged = each.withColumn("node", name("source")).join(component, "node").select("book", "source", "component")
    home = tagged.join(anchors, "book").where("source = anchor").select("book", F.col("component").alias("home"), "anchor")
    return tagged.join(home, "book").select("book", "source", (F.col("component") == F.col("home")).alias("in_cluster"), "anchor")


def choose_base(stats: DataFrame, priority: list[str], *, guard: float = 0.2, per_source: dict[str, float] | None = None, protected: tuple[str, ...] = ()) -> DataFrame:
    """``(book, base, incumbent, candidate, richest, reason)``.

    ``stats``: book, source, max_depth, n_nodes, page_coverage. Able are sources with ``guard`` of the richest one's nodes and its
    depth. A protected incumbent (the best by priority) with structure stays; a flat one gives way to the richest able
    source; any other stays if it is able.
    """
    rank = rank_of(F.col("source"), priority)
    wealth = F.struct("max_depth", "n_nodes", "page_coverage", (-rank).alias("p"), "source")
    whole = Window.partitionBy("book")
    share = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in (per_source or {}).items() for x in pair]), F.col("source")), F.lit(guard)) if per_source else F.lit(guard)
    rows = stats.withColumn("_top", F.max(wealth).over(whole)).withColumn("_flat", F.col("max_depth") <= 1).withColumn("_able", (F.col("n_nodes") >= share * F.col("_top.n_nodes")) & (F.col("max_depth") >= F.col("_top.max_depth")))
    g = rows.groupBy("book").agg(
        F.min(F.struct(rank.alias("r"), "source", "_flat", "_able")).alias("inc"), F.max(F.when(F.col("_able"), wealth)).alias("cand"), F.max(wealth).alias("top"),
    )
    incumbent, candidate = F.col("inc.source"), F.coalesce(F.col("cand.source"), F.col("top.source"))
    keep = F.lit(False) if not protected else incumbent.isin(*protected) & ~F.col("inc._flat")
    wanted = F.when(keep, incumbent).when(F.col("inc._flat") & (candidate != incumbent), candidate).when(F.col("inc._able"), incumbent).otherwise(candidate)
    reason = F.when(keep, "protected incumbent kept").when(F.col("inc._flat") & (candidate != incumbent), "flat incumbent gives way").when(F.col("inc._able"), "incumbent kept").otherwise("candidate by the guard")
    able = (wanted == candidate) | F.col("inc._able")
    return g.select("book", F.when(able, wanted).otherwise(candidate).alias("base"), incumbent.alias("incumbent"), candidate.alias("candidate"), F.col("top.source").alias("richest"), F.when(able, reason).otherwise("candidate by the guard").alias("reason"))


def complete(nodes: DataFrame, sources: DataFrame, books: DataFrame, base: DataFrame, priority: list[str], part_sources: tuple[str, ...] = ()) -> DataFrame:
    """The base's nodes and, of headings it lacks, the first node of the best other source; each with its provenance.

    ``books``: book, page_offset. A page of the file becomes a printed one only by a validated offset of full confidence, else the
    node needs an offset. A source without a digest has no snapshot. Parts of a kind that is no content are rejected.
    """
    keyed = nodes.where(F.coalesce(F.col("k"), F.lit("")) != "").join(base.select("book", "base"), "book")
    own = keyed.where(F.col("source") == F.col("base")).withColumn("appended_from", F.lit(None).cast("string"))
    others = keyed.where(F.col("source") != F.col("base")).join(own.select("book", "k").distinct(), ["book", "k"], "left_anti")
    kinds = lambda names: F.col("source").isin(*part_sources) & F.col("part_kind").isin(names) if part_sources else F.lit(False)
    rejected = F.coalesce(kinds(REJECT_KINDS), F.lit(False))
    # a rejected part does not stand for its heading
    first = Window.partitionBy("book", "k", rejected).orderBy(rank_of(F.col("source"), priority), "source", "idx")
    others = others.withColumn("_n", F.row_number().over(first)).where((F.col("_n") == 1) | rejected).drop("_n").withColumn("appended_from", F.col("source"))
    every = own.unionByName(others).join(sources.select("book", "source", "provenance_origin", "source_sha256", "page_basis"), ["book", "source"], "left")
    offset = F.col("page_offset")
    every = every.join(books.select("book", F.when((offset["confidence"] >= 1) & offset["validated"], offset["offset"]).alias("_offset")), "book", "left")
    pdf = F.coalesce(F.col("page_is_pdf"), F.lit(False)) & F.col("page").isNotNull()
    convert = pdf & F.col("_offset").isNotNull()
    sha = F.nullif(F.trim("source_sha256"), F.lit(""))
    kind = F.when(rejected, "reject").when(kinds(ATTACH_KINDS), "attach").when(F.col("source").isin(*part_sources) & F.col("part_kind").isNotNull(), "review").otherwise("n/a") if part_sources else F.lit("n/a")
    locator = F.concat_ws("#", "source", F.col("idx").cast("string"))
    origin = F.coalesce("provenance_origin", "source")
    return every.select(
        "book", "source", "idx", "title", "k", "depth", F.when(convert, to_print_page(F.col("page"), F.col("_offset"))).otherwise(F.col("page")).alias("page"),
        F.when(convert, "print_page").when(pdf, "pdf_page").otherwise(page_basis(F.col("page_basis"))).alias("page_basis"), convert.alias("page_converted"), (pdf & F.col("_offset").isNull()).alias("needs_offset"),
        origin.alias("provenance_origin"), locator.alias("locator"), sha.alias("source_hash"), sha.isNull().alias("snapshot_missing"), kind.alias("kind_status"), "appended_from", "base", "author",
        F.substring(F.sha2(F.concat_ws("\x1f", "book", origin, locator, "k"), 256), 1, 16).alias("toc_node_id"),
    )


def lanes(completed: DataFrame, nodes: DataFrame, sources: DataFrame, cluster: DataFrame, least: int = 3) -> DataFrame:
    """Adds votes (declared origins of a heading within the cluster), consensus, lane and its reasons to completed nodes."""
    within = nodes.join(cluster.where("in_cluster").select("book", "source"), ["book", "source"], "left_semi").join(sources.select("book", "source", "provenance_origin"), ["book", "source"], "left")
    voted = C.votes(within.withColumn("_origin", F.coalesce("provenance_origin", "source")), "book", "k", "_origin", least)
    rows = completed.join(voted, ["book", "k"], "left").na.fill(0, ["votes"]).withColumn("consensus", F.coalesce("consensus", F.lit(False)))
    rows = C.lanes(rows.withColumn("_snapshot", ~F.col("snapshot_missing")).withColumn("_review", F.col("kind_status") == "review"), snapshot="_snapshot", consensus="consensus", review="_review", needs_offset="needs_offset")
    rejected = F.col("kind_status") == "reject"
    return rows.withColumn("lane", F.when(rejected, "rejected").otherwise(F.col("lane"))).withColumn("lane_reason", F.when(rejected, F.array(F.lit("part_kind"))).otherwise(F.col("lane_reason"))).drop("_snapshot", "_review")


def linked(laned: DataFrame, priority: list[str]) -> DataFrame:
    """The accepted nodes with the parent that their order and depth give: the base first, then the others by priority."""
    place = F.when(F.col("appended_from").isNull(), -1).otherwise(rank_of(F.col("source"), priority))
    rows = laned.where("lane = 'accepted'").withColumn("_place", place).withColumn("_level", F.least(F.greatest(F.coalesce("depth", F.lit(1)), F.lit(1)), F.lit(6)))
    return parents(rows, ["book"], ["_place", "source", "idx"], "toc_node_id", "_level").withColumnRenamed("parent", "parent_id").drop("_place", "_level")


#: names of the adoption gates
GATE_NAMES = ["no_rich_to_shallow", "provenance_complete", "no_invention", "votes_by_origin", "report_only", "one_lane", "accepted_is_sound", "non_adoptable_lacks_snapshot", "applies_accepted", "identity_regression"]
BLOCKERS = ["identity_unresolved", "provenance_incomplete", "non_consensus_or_empty", "authority_human_review", "non_adoptable_nodes_present"]


def envelopes(books: DataFrame, identity: DataFrame, base: DataFrame, laned: DataFrame, accepted: DataFrame, authority: DataFrame) -> DataFrame:
    """One row a book: base, counts by lane, a digest of what is accepted, whether it may be adopted and what stands against it.

    A book without a base still has its row, with the one blocker ``no_base``.
    """
    n = lambda lane: F.count_if(F.col("lane") == lane).alias(lane)
    counts = laned.groupBy("book").agg(n("accepted"), n("pending"), n("rejected"), n("non_adoptable"), F.count_if(F.array_contains("lane_reason", "non_consensus")).alias("lone"), F.bool_and(F.when(F.col("lane") == "accepted", F.col("source_hash").isNotNull())).alias("provenance"))
    sha = C.set_hash(accepted, "book", ["toc_node_id", "k", "page", "parent_id", "provenance_origin"]).withColumnRenamed("set_hash", "projection_sha")
    j = books.select("book").distinct().join(identity.select("book", F.col("status").alias("edition_identity")), "book", "left").join(base.select("book", F.col("base").alias("base_source")), "book", "left").join(counts, "book", "left").join(sha, "book", "left").join(authority.select("book", "authority"), "book", "left")
    j = j.na.fill(0, ["accepted", "pending", "rejected", "non_adoptable", "lone"])
    ok = {"identity_unresolved": F.col("edition_identity").startswith(C.SAME), "provenance_incomplete": F.coalesce("provenance", F.lit(True)), "non_consensus_or_empty": (F.col("accepted") > 0) & (F.col("lone") == 0), "authority_human_review": F.col("authority") != "human_review", "non_adoptable_nodes_present": F.col("non_adoptable") == 0}
    stands = F.array_compact(F.array(*[F.when(~F.coalesce(ok[b], F.lit(False)), F.lit(b)) for b in BLOCKERS]))
    blockers = F.when(F.col("base_source").isNull(), F.array(F.lit("no_base"))).otherwise(stands)
    return j.select("book", "edition_identity", "base_source", "authority", "accepted", "pending", "rejected", "non_adoptable", "projection_sha", blockers.alias("blockers"), (F.size(blockers) == 0).alias("adoptable"), F.lit("accepted_node_set").alias("apply_target"), F.lit(True).alias("report_only"))


def base_distribution(accepted: DataFrame) -> DataFrame:
    """``(book, from_source, n)``: how many accepted nodes each source gave."""
    return accepted.groupBy("book", F.coalesce("appended_from", "base").alias("from_source")).agg(F.count(F.lit(1)).alias("n"))


def rollup(envelope: DataFrame) -> DataFrame:
    """One row: books, adoptable ones, accepted and pending nodes."""
    return envelope.agg(F.count(F.lit(1)).alias("books"), F.count_if("adoptable").alias("adoptable"), F.sum("accepted").alias("accepted"), F.sum("pending").alias("pending"))


def same_projection(a: DataFrame, b: DataFrame, nodes_a: DataFrame, nodes_b: DataFrame) -> DataFrame:
    """``(book, rule)``: books whose projections differ between two runs, by presence, digest, base or nodes."""
    side = lambda df, p: df.select("book", F.col("projection_sha").alias(f"{p}_sha"), F.col("base_source").alias(f"{p}_base"), F.lit(True).alias(f"{p}_there"))
    j = side(a, "a").join(side(b, "b"), "book", "full_outer")
    cols = ["book", "toc_node_id", "parent_id", "k", "page", "provenance_origin", "source_hash"]
    moved = nodes_a.select(*cols).exceptAll(nodes_b.select(*cols)).union(nodes_b.select(*cols).exceptAll(nodes_a.select(*cols))).select("book").distinct().withColumn("moved", F.lit(True))
    j = j.join(moved, "book", "left")
    both = F.col("a_there") & F.col("b_there")
    return violations(j, "book", {"in_both": both, "same_digest": ~F.coalesce(both, F.lit(False)) | F.col("a_sha").eqNullSafe(F.col("b_sha")), "same_base": ~F.coalesce(both, F.lit(False)) | F.col("a_base").eqNullSafe(F.col("b_base")), "same_nodes": F.col("moved").isNull()})


def adoption_gates(envelope: DataFrame, laned: DataFrame, accepted: DataFrame, nodes: DataFrame, sources: DataFrame, stats: DataFrame, *, guard: float = 0.2, gold: DataFrame | None = None) -> DataFrame:
    """``(gate, item)`` of every breach; an empty table passes.

    No base poorer than the guard or flatter than the richest; five fields of provenance on every accepted node; no accepted
    node that its source lacks; no more votes than declared origins; reports only; each node in one lane, accepted ones whole.
    ``gold`` (case_id, expected_same, got_same): identities that must not change, either way.
    """
    c = F.col
    named = lambda df, gate, item: df.select(F.lit(gate).alias("gate"), item.cast("string").alias("item"))
    top = stats.groupBy("book").agg(F.max(F.struct("max_depth", "n_nodes")).alias("top"))
    poor = envelope.select("book", F.col("base_source").alias("source")).join(stats, ["book", "source"]).join(top, "book").where((c("n_nodes") < guard * c("top.n_nodes")) | (c("max_depth") < c("top.max_depth")))
    bare = violations(accepted.withColumn("_n", c("toc_node_id")), "_n", {f: F.coalesce(c(f).cast("string"), F.lit("")) != "" for f in ("source", "provenance_origin", "locator", "source_hash", "toc_node_id")})
    made_up = accepted.join(nodes.select("book", "source", "idx"), ["book", "source", "idx"], "left_anti")
    origins = sources.groupBy("book").agg(F.count_distinct(F.coalesce("provenance_origin", "source")).alias("_origins"))
    over = accepted.join(origins, "book").where(c("votes") > c("_origins"))
    twice = laned.groupBy("toc_node_id").agg(F.count_distinct("lane").alias("n")).where("n > 1")
    unsound = accepted.where(~c("consensus") | c("source_hash").isNull() | c("snapshot_missing") | c("needs_offset") | (c("lane") != "accepted"))
    misplaced = laned.where((c("lane") == "non_adoptable") & ~c("snapshot_missing"))
    found = [
        named(poor, "no_rich_to_shallow", c("book")), named(bare, "provenance_complete", c("_n")), named(made_up, "no_invention", c("locator")), named(over, "votes_by_origin", c("toc_node_id")),
        named(envelope.where(~F.coalesce(c("report_only"), F.lit(False))), "report_only", c("book")), named(twice, "one_lane", c("toc_node_id")), named(unsound, "accepted_is_sound", c("toc_node_id")), named(misplaced, "non_adoptable_lacks_snapshot", c("toc_node_id")),
        named(envelope.where(c("apply_target") != "accepted_node_set"), "applies_accepted", c("book")),
    ]
    if gold is not None:
        found.append(named(gold.where(c("expected_same") != c("got_same")), "identity_regression", c("case_id")))
    return reduce(DataFrame.unionByName, found)
