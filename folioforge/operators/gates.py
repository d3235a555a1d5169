"""Gates: each is a table of violations ``(key, rule)``, and an empty one passes. What is unknown is a violation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.operators.evidence import ASSERTIVE, DRAFTER_SOURCES
from folioforge.operators.ledger import reachability, violations
from folioforge.operators.revisions import RELOCATE_SIM, RENUMBER_SIM

# The domains of kinds of change, treatments and claims.
DELTA_KINDS = ["no_change", "substitution", "insertion", "repeal", "renumber", "relocate", "split", "join"]
TREATMENTS = ["followed", "applied", "approved", "relied_upon", "cited", "considered", "explained", "distinguished", "limited", "questioned", "criticized", "called_into_doubt", "declined_to_extend", "followed_with_reservations", "not_applied", "overruled", "abrogated", "disapproved", "superseded_by_statute"]
STRONG_ONLY = ["overruled", "abrogated", "disapproved", "superseded_by_statute"]
CHANGE_TYPES = ["no_substantive_change", "wording_clarification", "scope_expansion", "scope_reduction", "requirement_added", "requirement_removed", "requirement_changed", "effect_changed", "subject_changed", "procedure_changed", "efficacy_change", "substantive_change_unspecified", "disputed", "unknown"]
SUBSTANTIVE_FIELDS = {"change_type", "stance", "doctrine_label", "substantive_change_type"}


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _off(c: str) -> Column:
    return ~F.coalesce(F.col(c), F.lit(False))


def delta_gates(deltas: DataFrame) -> DataFrame:
    """Six gates over textual changes: known kind, nothing about substance, provenance, justified new numbers, unchanged texts, named parts.

    A new number needs nearly the same text, or at least the likeness of a move and another new number of the law
    that shifts as far. Provenance columns that are missing count as empty.
    """
    c = F.col
    names = ["detector_version", "source_snapshot_id", "from_revision", "to_revision"]
    rows = deltas.withColumn("_key", F.concat_ws("/", "law_id", "article_path")).withColumns({n: F.lit("") for n in names if n not in deltas.columns})
    number = lambda x: F.regexp_extract(x, r"^[^:]*:(\d+)", 1).try_cast("int")
    shift = number(F.try_element_at("counterpart_paths", F.lit(1))) - number(c("article_path"))
    rows = rows.withColumn("_shift", F.when(c("delta_kind") == "renumber", shift))
    rows = rows.withColumn("_alike", F.when(c("_shift").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy("law_id", "_shift"))))
    return violations(rows, "_key", {
        "known_kind": c("delta_kind").isin(DELTA_KINDS),
        "nothing_of_substance": F.lit(not SUBSTANTIVE_FIELDS & set(deltas.columns)),
        "provenance": reduce(lambda x, y: x & y, [_filled(n) for n in names]),
        "new_number_justified": (c("delta_kind") != "renumber") | (c("similarity") >= RENUMBER_SIM) | ((c("similarity") >= RELOCATE_SIM) & (c("_alike") >= 2)),
        "unchanged_text": (c("delta_kind") != "no_change") | (c("similarity") == 1),
        "parts_named": ~c("delta_kind").isin("split", "join") | (F.size("counterpart_paths") >= 2),
    })


def treatment_gates(rows: DataFrame, key: str) -> DataFrame:
    """Six gates over treatments: candidates only, no support of claims, known treatment, a span, a cue for a strong one, never high confidence."""
    c = F.col
    return violations(rows, key, {
        "candidate": c("status") == "candidate", "no_claim_support": _off("claim_support"), "known_treatment": c("treatment").isin(TREATMENTS),
        "evidence_span": _filled("citation") & (c("span_end") > c("span_start")), "strong_has_cue": ~c("treatment").isin(STRONG_ONLY) | _filled("cue"), "no_high_confidence": c("confidence") != "high",
    })


def drafter_gates(claims: DataFrame, key: str) -> DataFrame:
    """Eight gates over drafters' claims: candidates only, no support, tier 2 from a drafter's source, known change, a quotation, a cue, never high confidence, a provision."""
    c = F.col
    return violations(claims, key, {
        "candidate": c("status") == "candidate", "no_claim_support": _off("claim_support"), "tier_2": (c("source_tier") == 2) & c("source_type").isin(DRAFTER_SOURCES), "known_change": c("change_type").isin(CHANGE_TYPES),
        "evidence": _filled("quoted_text"), "cue": _filled("cue"), "no_high_confidence": c("confidence") != "high", "provision": _filled("article_path"),
    })


def dispute_gates(found: DataFrame, claims: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Seven gates over assembled claims, review events and disputes.

    ``claims``: key, status, counter_key, dispute_id, claim_support, lawtime_resolved; ``events``: event_id,
    new_status, basis. What has a counter is disputed and supports nothing; support needs acceptance, no counter
    and a settled time; the assembler accepts nothing; nobody counters itself; both sides of a dispute are filled;
    events tell their basis; a disputed claim names its dispute and counter.
    """
    c = F.col
    a = violations(claims, key, {
        "counter_blocks": c("counter_key").isNull() | (_off("claim_support") & (c("status") == "disputed")),
        "support_needs_acceptance": _off("claim_support") | ((c("status") == "accepted") & c("counter_key").isNull() & F.coalesce(c("lawtime_resolved"), F.lit(False))),
        "no_self_counter": c("counter_key").isNull() | (c("counter_key") != c(key)), "disputed_is_told": (c("status") != "disputed") | (c("dispute_id").isNotNull() & c("counter_key").isNotNull()),
    }).withColumnRenamed(key, "item")
    b = violations(events, "event_id", {"never_accepts": c("new_status") != "accepted", "basis": _filled("basis")}).withColumnRenamed("event_id", "item")
    d = violations(found, "dispute_id", {"both_sides": (F.size("continuity_side") > 0) & (F.size("change_side") > 0)}).withColumnRenamed("dispute_id", "item")
    return a.unionByName(b).unionByName(d)


def view_gates(views: DataFrame, key: str) -> DataFrame:
    """Five gates over rendered provisions: no assertive output, both sides of a dispute, nothing relied upon, no assertion in the summary, a source and stance for every claim."""
    c = F.col
    has = lambda names: F.exists("claims", lambda x: x["stance"].isin(names))
    return violations(views, key, {
        "not_assertive": _off("assertive_output_allowed"),
        "both_sides": (c("disposition") != "disputed") | (c("both_sides_required") & has(["continues"]) & has(["changed", "qualified", "disputed"]) & (F.size("claims") >= 2)),
        "not_relied_upon": F.forall("claims", lambda x: x["usage"] == "for reference, not relied upon"), "summary_asserts_nothing": ~c("summary").rlike(ASSERTIVE),
        "attributed": F.forall("claims", lambda x: (F.coalesce(x["source"], F.lit("")) != "") & (F.coalesce(x["stance"], F.lit("")) != "")),
    })


def manifest_gates(nodes: DataFrame, edges: DataFrame, kinds: list[str]) -> DataFrame:
    """``(item, rule)``: duplicate stages, unknown dependencies, unknown probe kinds, cycles."""
    twice = nodes.groupBy("stage").count().where("count > 1").select(F.col("stage").alias("item"), F.lit("duplicate_id").alias("rule"))
    unknown = edges.join(nodes.select(F.col("stage").alias("b")), "b", "left_anti").select(F.col("b").alias("item"), F.lit("unknown_dependency").alias("rule")).distinct()
    kind = nodes.where(~F.coalesce(F.col("probe").isin(kinds), F.lit(False))).select(F.col("stage").alias("item"), F.lit("bad_probe").alias("rule"))
    ring = reachability(edges).where("a = b").select(F.col("a").alias("item"), F.lit("cycle").alias("rule")).distinct()
    return reduce(DataFrame.unionByName, [twice, unknown, kind, ring])


def passed(gates: dict[str, DataFrame]) -> DataFrame:
    """``(gate, violations, ok)`` of named gates."""
    rows = [g.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("gate"), "violations", (F.col("violations") == 0).alias("ok")) for name, g in gates.items()]
    return reduce(DataFrame.unionByName, rows)


def approval(kind: Column, free: list[str]) -> Column:
    """free for the listed kinds; anything else, unknown too, is gated."""
    return F.when(F.coalesce(kind.isin(free), F.lit(False)), "free").otherwise("gated")
