"""Record linkage decisions: identity, strong and soft matches, join actions, preflight."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def identity_by_group(records: DataFrame, key: str, *, titles: str, publisher: str, page_tolerance: float = 0.1) -> DataFrame:
    """Set-based identity of each group's records: suspected, same or insufficient.

    More than one isbn, title, edition, volume or year, or page counts apart by more
    than the tolerance, make it suspected; one shared isbn, or one title with one
    publisher, make it same; a single record says nothing.
    """
    many = lambda c: F.count_distinct(F.nullif(F.trim(c), F.lit("")))
    g = records.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), many("isbn").alias("isbns"), many(titles).alias("titles"), many("edition").alias("editions"), many("volume").alias("volumes"), many("year").alias("years"),
        many(publisher).alias("publishers"), F.min(F.when(F.col("page_count") > 0, F.col("page_count"))).alias("lo"), F.max(F.when(F.col("page_count") > 0, F.col("page_count"))).alias("hi"),
    )
    apart = F.coalesce((F.col("hi") - F.col("lo")) / F.col("hi") > page_tolerance, F.lit(False))
    reasons = F.array_compact(F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in ("isbns", "titles", "editions", "volumes", "years")], F.when(apart, F.lit("pages"))))
    status = (
        F.when(F.col("n") < 2, "insufficient_evidence").when(F.size(reasons) > 0, "suspected_different_manifestation")
        .when((F.col("isbns") == 1) | ((F.col("titles") == 1) & (F.col("publishers") == 1)), "resolved_same_manifestation").otherwise("insufficient_evidence")
    )
    return g.select(key, "n", F.array_join(reasons, ",").alias("reasons"), status.alias("status"))


def evidence_status(e: dict[str, Column]) -> Column:
    """Status of a pair from its evidence states, first rule that holds.

    States: MATCH, MISMATCH, UNKNOWN, WITHIN (years), DIVERGENT, PARSE_ERROR, ASYMMETRY,
    CONTAINMENT; keys: isbn, edition, volume, title_edition, core, year, page, publisher,
    author, unknown_marker (boolean).
    """
    is_ = lambda k, *v: F.coalesce(e[k].isin(*v), F.lit(False))
    signals = reduce(lambda a, b: a + b, [F.when(is_(k, "MATCH"), 1).otherwise(0) for k in ("edition", "publisher", "author", "page", "title_edition")]) + F.when(is_("year", "MATCH", "WITHIN"), 1).otherwise(0)
    rules = [
        (is_("isbn", "MISMATCH"), "suspected:isbn_mismatch"), (is_("edition", "MISMATCH"), "suspected:edition_field_conflict"), (is_("volume", "MISMATCH"), "suspected:volume_conflict"),
        (is_("title_edition", "MISMATCH"), "suspected:edition_number_conflict"), (is_("core", "DIVERGENT"), "suspected:genuine_title_diff"),
        (is_("year", "DIVERGENT") & ~is_("isbn", "MATCH"), "suspected:year_divergence"), (F.coalesce(e["unknown_marker"], F.lit(False)), "insufficient:unknown_edition_marker"),
        (is_("year", "PARSE_ERROR"), "insufficient:year_parse_error"), (is_("year", "DIVERGENT"), "insufficient:year_divergence_anomaly"), (is_("title_edition", "ASYMMETRY"), "insufficient:edition_marker_asymmetry"),
        (is_("core", "CONTAINMENT") & ~is_("isbn", "MATCH"), "insufficient:title_containment_only"), (is_("page", "DIVERGENT"), "insufficient:page_divergence"),
        (is_("publisher", "MISMATCH"), "insufficient:publisher_divergence"), (is_("isbn", "MATCH"), "same:isbn_match"), (is_("core", "MATCH") & (signals >= 2), "same:title_core_agree"),
    ]
    out = F
    for cond, label in rules:
        out = out.when(cond, label)
    return out.otherwise("insufficient:insufficient_positive_evidence")


def text_evidence(a: Column, b: Column) -> Column:
    """MATCH or MISMATCH where both sides say something, else UNKNOWN."""
    blank = lambda c: c.isNull() | (c == "")
    return F.when(blank(a) | blank(b), "UNKNOWN").when(a == b, "MATCH").otherwise("MISMATCH")


def year_evidence(a: Column, b: Column, tolerance: int = 1) -> Column:
    """From two ``year_state`` structs."""
    gap = F.abs(a["value"] - b["value"])
    return (
        F.when((a["state"] == "parse_error") | (b["state"] == "parse_error"), "PARSE_ERROR").when(gap.isNull(), "UNKNOWN").when(gap == 0, "MATCH").when(gap <= tolerance, "WITHIN").otherwise("DIVERGENT")
    )


def page_evidence(a: Column, b: Column, tolerance: float = 0.1) -> Column:
    good = (a > 0) & (b > 0)
    return F.when(~F.coalesce(good, F.lit(False)), "UNKNOWN").when(F.abs(a - b) / F.greatest(a, b) <= tolerance, "MATCH").otherwise("DIVERGENT")


def worst_pair(pairs: DataFrame, key: str, status: str, order: str) -> DataFrame:
    """The worst status of a group's pairs (suspected, insufficient, same); the first of equals."""
    rank = F.when(F.col(status).startswith("suspected"), 3).when(F.col(status).startswith("insufficient"), 2).otherwise(1)
    return pairs.groupBy(key).agg(F.max(F.struct(rank.alias("r"), (-F.col(order)).alias("o"), F.col(status).alias("s")))["s"].alias(status))


def best_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, str, list[str]]]) -> DataFrame:
    """For each left row the strongest tier that finds a right row: ``(left_id, strength, reason, right_id)``.

    ``tiers``: (strength, reason, key columns), best first; a null or empty key part matches
    nothing. Each tier is one join against that tier's least right id, so no tier multiplies rows.
    """
    out, parts = left, []
    for n, (strength, reason, keys) in enumerate(tiers):
        filled = reduce(lambda a, b: a & b, [F.coalesce(F.col(k) != "", F.lit(False)) for k in keys])
        side = right.where(filled).groupBy(*keys).agg(F.min(right_id).alias(f"_m{n}"))
        out = out.join(side, keys, "left")
        parts.append(F.when(F.col(f"_m{n}").isNotNull(), F.struct(F.lit(strength).alias("strength"), F.lit(reason).alias("reason"), F.col(f"_m{n}").alias(right_id))))
    return out.withColumn("_best", F.coalesce(*parts)).select(left_id, "_best.strength", "_best.reason", F.col(f"_best.{right_id}").alias(right_id))


def join_action(state: Column, rich: Column, protected: Column, already: Column) -> Column:
    """create, skip_idempotent, route_human_review or overwrite_simple, in this order of precedence.

    ``state``: null (nothing there), 'simple' or anything else.
    """
    guard = F.coalesce(protected, F.lit(False)) | F.coalesce(rich, F.lit(False)) | (state != "simple")
    return F.when(state.isNull(), "create").when(F.coalesce(already, F.lit(False)), "skip_idempotent").when(guard, "route_human_review").otherwise("overwrite_simple")


def ambiguity(links: DataFrame, left: str, right: str) -> DataFrame:
    """Links whose left end has several right ends, or the other way round."""
    pairs = links.where(F.col(left).isNotNull() & F.col(right).isNotNull()).select(left, right).distinct()
    counted = pairs.join(pairs.groupBy(left).agg(F.count(F.lit(1)).alias("rights")), left).join(pairs.groupBy(right).agg(F.count(F.lit(1)).alias("lefts")), right)
    return counted.where("rights > 1 or lefts > 1").select(left, right, "rights", "lefts")


def triage(a: Column, b: Column) -> Column:
    """candidate_richer (holds 0.8 of the smaller and is larger), near_duplicate (Jaccard 0.6) or conflict."""
    from folioforge.functions.text import containment, jaccard

    return F.when((containment(a, b) >= 0.8) & (F.size(b) > F.size(a)), "candidate_richer").when(jaccard(a, b) >= 0.6, "near_duplicate").otherwise("conflict")


# Fixed values: (tier, score) of a citation by how its targets were found.
CITATION_TIERS = {
    "exact": ("A", 0.95), "exact_alias": ("B", 0.90), "issue_page_collision": ("D", 0.60), "issue_unique": ("C", 0.50), "issue_multi": ("D", 0.40),
    "court_date_unique": ("C", 0.60), "court_date_multi": ("D", 0.45), "index_absent": ("D", 0.0), "insufficient_signal": ("D", 0.0), "policy_blocked": ("X", 0.0), "authority_missing": ("X", 0.0),
}


def _targets(index: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """How many targets a key has and the least of them: numbers of fixed size, whatever a key gathers."""
    return index.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.count_distinct(value).alias(f"{name}_n"), F.min(value).alias(f"{name}_one"))


def cite_lookup(edges: DataFrame, journals: DataFrame, judgments: DataFrame, *, aliases: dict[str, str], authority: bool = True) -> DataFrame:
    """``(edge_id, match_basis, tier, score, sibling_count, target)`` of citations to judgments.

    ``edges``: edge_id, edge_type, locator, court, date; ``journals``: target, journal, issue, page; ``judgments``: target, court,
    date. A journal citation is looked up by journal, issue and page, then by journal and issue; one that an alias led to is a
    tier lower. A dated one is looked up by court and date. ``target`` is the one target, null where there are several
    (:func:`cite_targets` lists them). Without an authority snapshot nothing is suggested.
    """
    from folioforge.functions.text import journal_key, locator_parts, narrow

    e = edges.select("edge_id", "edge_type", locator_parts(F.col("locator")).alias("at"), F.trim(F.coalesce("court", F.lit(""))).alias("court"), F.trim(F.coalesce("date", F.lit(""))).alias("date"))
    e = e.withColumn("journal", F.when(F.col("at").isNotNull(), journal_key(F.col("at.journal"), aliases))).withColumn("issue", F.col("at.issue")).withColumn("page", narrow(F.col("at.page"))).withColumn("alias", F.col("journal") != F.col("at.journal"))
    index = journals.where("target is not null and target <> ''").select("target", journal_key(F.col("journal"), aliases).alias("journal"), narrow(F.coalesce("issue", F.lit(""))).alias("issue"), narrow(F.coalesce("page", F.lit(""))).alias("page"))
    dated = judgments.where("target is not null and target <> ''").select("target", F.trim(F.coalesce("court", F.lit(""))).alias("court"), F.trim(F.coalesce("date", F.lit(""))).alias("date"))
    j = e.join(_targets(index, ["journal", "issue", "page"], "target", "p"), ["journal", "issue", "page"], "left").join(_targets(index, ["journal", "issue"], "target", "i"), ["journal", "issue"], "left").join(_targets(dated, ["court", "date"], "target", "c"), ["court", "date"], "left")
    by_journal = F.col("edge_type") == "cites_judgment_via_journal"
    n = lambda x: F.coalesce(f"{x}_rows", F.lit(0))
    basis = (
        F.when(F.lit(not authority), "authority_missing")
        .when(by_journal, F.when(F.col("at").isNull(), "insufficient_signal").when(n("p") == 1, F.when(F.col("alias"), "exact_alias").otherwise("exact")).when(n("p") > 1, "issue_page_collision").when(n("i") == 1, "issue_unique").when(n("i") > 1, "issue_multi").otherwise("index_absent"))
        .when(F.col("edge_type") == "cites_judgment_by_date", F.when(n("c") == 1, "court_date_unique").when(n("c") > 1, "court_date_multi").otherwise("index_absent"))
        .otherwise("policy_blocked")
    )
    j = j.withColumn("match_basis", basis)
    of = lambda k: F.create_map(*[F.lit(x) for b, t in CITATION_TIERS.items() for x in (b, t[k])])[F.col("match_basis")]
    name = F.when(F.col("match_basis").isin("exact", "exact_alias", "issue_page_collision"), "p").when(F.col("match_basis").isin("issue_unique", "issue_multi"), "i").when(F.col("match_basis").startswith("court_date"), "c")
    pick = lambda c: F.coalesce(*[F.when(name == x, F.col(f"{x}_{c}")) for x in "pic"])
    siblings = F.coalesce(pick("n"), F.lit(0))
    return j.select("edge_id", "match_basis", of(0).alias("tier"), of(1).alias("score"), siblings.alias("sibling_count"), F.when(siblings == 1, pick("one")).alias("target"))


def cite_targets(looked_up: DataFrame, edges: DataFrame, journals: DataFrame, judgments: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """``(edge_id, target)``: every target that an edge's basis found, one row each."""
    from folioforge.functions.text import journal_key, locator_parts, narrow

    e = looked_up.select("edge_id", "match_basis").join(edges, "edge_id").withColumn("at", locator_parts(F.col("locator")))
    e = e.select("edge_id", "match_basis", journal_key(F.col("at.journal"), aliases).alias("journal"), F.col("at.issue").alias("issue"), narrow(F.col("at.page")).alias("page"), F.trim("court").alias("court"), F.trim("date").alias("date"))
    index = journals.select("target", journal_key(F.col("journal"), aliases).alias("journal"), narrow(F.coalesce("issue", F.lit(""))).alias("issue"), narrow(F.coalesce("page", F.lit(""))).alias("page"))
    dated = judgments.select("target", F.trim("court").alias("court"), F.trim("date").alias("date"))
    a = e.where("match_basis in ('exact', 'exact_alias', 'issue_page_collision')").join(index, ["journal", "issue", "page"]).select("edge_id", "target")
    b = e.where("match_basis in ('issue_unique', 'issue_multi')").join(index.drop("page"), ["journal", "issue"]).select("edge_id", "target")
    c = e.where("match_basis like 'court_date%'").join(dated, ["court", "date"]).select("edge_id", "target")
    return a.union(b).union(c).distinct()


def covers(valid_from: Column, valid_to: Column, at: Column) -> Column:
    """Whether a half-open span covers a time; null ends are open, a null time is covered by nothing."""
    return F.coalesce(at.isNotNull() & (valid_from.isNull() | (at >= valid_from)) & (valid_to.isNull() | (at < valid_to)), F.lit(False))


def with_fallback(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Left rows with the right side's fields, and their own where the right side is missing."""
    other = right.select(key, F.struct(*fields).alias("_r"))
    j = left.join(other, key, "left")
    return j.select(*[F.when(F.col("_r").isNotNull(), F.col(f"_r.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in left.columns], F.col("_r").isNotNull().alias("found"))


def asof_join(left: DataFrame, right: DataFrame, by: str, left_at: str, right_at: str, keep: list[str]) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time.

    One union sorted by time and a running last value: no range join, so a key with
    many rows costs a sort and not a product.
    """
    payload = F.struct(F.col(right_at).alias("_ra"), *keep)
    a = left.withColumn("_t", F.col(left_at)).withColumn("_side", F.lit(1)).withColumn("_r", F.lit(None).cast(right.select(payload.alias("r")).schema["r"].dataType))
    b = right.select(F.col(by), F.col(right_at).alias("_t"), F.lit(0).alias("_side"), payload.alias("_r"))
    w = Window.partitionBy(by).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_last", F.last("_r", ignorenulls=True).over(w))
    return both.where("_side = 1").select(*left.columns, F.col("_last._ra").alias(right_at), *[F.col(f"_last.{c}").alias(c) for c in keep])


def _position(c: Column, kinds: set[str]) -> Column:
    """A whole number that never falls where ``c`` rises, for columns of these types: integers as they are, else seconds or microseconds since 1970."""
    if kinds <= {"tinyint", "smallint", "int", "bigint"}:
        return c.cast("bigint")
    if kinds <= {"timestamp_ntz", "date"}:  # without a zone, as not every zone keeps their order
        return (c.cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("bigint")
    return F.unix_micros(c.cast("timestamp"))


def overlapping(spans: DataFrame, by: str, key: str, start: str, end: str) -> DataFrame:
    """Pairs of half-open spans of one key that overlap, each pair of rows once; null ends are open.

    A span lies in one or two cells (integers beyond 2**61 apart: five) of a width that follows from its length (2 to 8
    times it, powers of four), so a key with many spans joins neighbours and not all with all, and what is placed does
    not grow with the lengths; a pair counts in the cell where the later of the two begins. Spans of unlike widths meet in
    the cells of the wider one, so the shorter is placed again for each wider width in use. Open ends are kept apart and
    meet by the key alone: they do overlap nearly everything. The widths in use (at most 31) are gathered first, and
    steps that no span needs are left out.
    """
    kinds = {spans.schema[c].dataType.simpleString() for c in (start, end)}
    rows = spans.select(by, F.col(key).alias("k"), F.col(start).alias("s"), F.col(end).alias("e"))
    at = lambda c: _position(F.col(c), kinds)
    length = F.coalesce(F.try_subtract(at("e"), at("s")), F.lit(2**63 - 1)).cast("double")
    width = F.least(F.ceil((F.log2(length + 1) + 1) / 2) * 2, F.lit(62)).cast("int")
    closed = rows.where("s is not null and e is not null and s < e").withColumn("w", width)
    opened = F.col("s").isNull() | F.col("e").isNull()
    used, any_open = rows.agg(F.bit_or(F.when(F.col("s") < F.col("e"), F.call_function("shiftleft", F.lit(1).cast("bigint"), width))), F.max(opened)).first()
    widths = [w for w in range(63) if (used or 0) >> w & 1]

    def cells(df: DataFrame, n: int) -> DataFrame:
        low, high = (F.call_function("shiftright", at(c), F.col("w")) for c in ("s", "e"))
        cut = df.select("*", F.posexplode(F.sequence(low, high)).alias("nth", "cell"))
        return cut.select(by, "w", "cell", *[F.col(c).alias(f"{c}{n}") for c in ("k", "s", "e", "nth")])

    meet = "s1 < e2 and s2 < e1 and (nth1 = 0 or nth2 = 0)"
    pairs = cells(closed, 1).join(cells(closed, 2), [by, "w", "cell"]).where(f"k1 < k2 and {meet}").select(by, F.col("k1").alias("a"), F.col("k2").alias("b"))
    ordered = [by, F.least("k1", "k2").alias("a"), F.greatest("k1", "k2").alias("b")]
    if len(widths) > 1:
        wider = F.filter(F.array(*[F.lit(w) for w in widths]), lambda w: w > F.col("own"))
        short = closed.withColumnRenamed("w", "own").withColumn("w", F.explode(wider)).drop("own")
        pairs = pairs.union(cells(closed.where(F.col("w") > widths[0]), 1).join(cells(short, 2), [by, "w", "cell"]).where(f"k1 <> k2 and {meet}").select(*ordered))
    if any_open:
        side = lambda df, n: df.select(by, *[F.col(c).alias(f"{c}{n}") for c in ("k", "s", "e")])
        before = lambda x, y: F.col(x).isNull() | F.col(y).isNull() | (F.col(x) < F.col(y))
        far = side(rows.where(opened), 1).join(side(rows, 2), by).where("k1 < k2 or (k1 <> k2 and s2 is not null and e2 is not null)").where(before("s1", "e2") & before("s2", "e1"))
        pairs = pairs.union(far.select(*ordered))
    return pairs


def cooccurrence(members: DataFrame, section: str, member: str) -> DataFrame:
    """Unordered pairs of members that share sections, with the number of them."""
    m = members.select(section, member).distinct()
    pairs = m.select(section, F.col(member).alias("a")).join(m.select(section, F.col(member).alias("b")), section).where("a < b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight"))
