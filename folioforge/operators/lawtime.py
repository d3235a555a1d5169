"""Assertions about statutes in time: formal states of laws and the gates over assertions, evidence and references.

Gates are violation tables ``(gate, key)``. ``claims`` holds all three families of assertions: id, kind
(substantive_change, interpretation_transition, old_law_survival), status, counter_id, evidence_id, claim_support,
related_delta_id, source_tier, value, law_work_id, article_path, rank, rank_reason, from_revision, to_revision.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import article_root


def formal_status(revisions: DataFrame) -> DataFrame:
    """``(law_id, formal_status, current_from)`` of revisions (law_id, revision_status, valid_from): in force, else repealed, superseded, not yet in force."""
    has = lambda s: F.coalesce(F.bool_or(F.col("revision_status") == s), F.lit(False))
    state = F.when(has("CurrentEnforced"), "in_force").when(has("Repeal"), "repealed").when(has("PreviousEnforced"), "superseded").when(has("UnEnforced"), "not_yet_in_force").otherwise("unknown")
    return revisions.groupBy("law_id").agg(state.alias("formal_status"), F.max(F.when(F.col("revision_status") == "CurrentEnforced", F.col("valid_from"))).alias("current_from"))


def _no(c: str):
    return ~F.coalesce(F.col(c), F.lit(False))


def claim_gates(claims: DataFrame, events: DataFrame, evidence: DataFrame, resolved: DataFrame, revisions: DataFrame) -> DataFrame:
    """Violations of the gates over claims, every branch in one table.

    ``events``: kind, id, new_status, basis; ``evidence``: evidence_id and its seven locator fields; ``resolved``: law_work_id,
    lawtime_resolved, temporal_status; ``revisions``: law_id, revision_id, revision_status, valid_from.
    """
    c = F.col
    tag = lambda df, gate, key="id": df.select(F.lit(gate).alias("gate"), c(key).cast("string").alias("key"))
    strong = c("status").isin("reviewed", "accepted")
    change = claims.where("kind = 'substantive_change'")
    known = resolved.groupBy("law_work_id").agg(F.bool_or("lawtime_resolved").alias("_ok"), F.bool_or(c("lawtime_resolved") & (c("temporal_status") != "unchecked")).alias("_checked"))
    timed = claims.join(known, "law_work_id", "left")
    unsound = (c("status") != "accepted") | c("counter_id").isNotNull() | c("evidence_id").isNull()
    told = events.where("new_status = 'accepted' and coalesce(basis, '') <> ''").select("kind", "id").distinct()
    needed = claims.where(strong | c("claim_support")).select("evidence_id").where("evidence_id is not null").distinct()
    fields = ["source_uri", "source_type", "source_tier", "locator", "source_span_hash", "retrieved_at", "parser_version"]
    bare = reduce(lambda a, b: a | b, [c(f).isNull() for f in fields])
    root = lambda df, name: df.withColumn(name, article_root(F.coalesce("article_path", F.lit(""))))
    drafters = root(change.where("source_tier = 2 and value = 'no_substantive_change' and status = 'accepted'"), "root")
    courts = root(claims.where("kind = 'interpretation_transition' and source_tier = 3 and value in ('interpretation_discontinued', 'interpretation_modified')"), "root").select("law_work_id", "root").distinct()
    rev = revisions.select("revision_id").distinct()
    lost = lambda col: change.where(c(col).isNotNull()).join(rev.withColumnRenamed("revision_id", col), col, "left_anti")
    gates = [
        tag(change.where(c("related_delta_id").isNotNull() & c("evidence_id").isNull() & strong), "amendment_not_auto_substantive"),
        tag(change.where(strong & c("evidence_id").isNull()), "substantive_requires_evidence"),
        tag(claims.where(c("counter_id").isNotNull() & (c("claim_support") | (c("status") != "disputed"))), "disputed_blocks_claim"),
        tag(timed.where(c("claim_support") & (unsound | _no("_ok"))), "claim_support_requires_accepted"),
        tag(claims.where("status = 'accepted'").join(told, ["kind", "id"], "left_anti"), "accepted_requires_review_event"),
        tag(evidence.join(needed, "evidence_id", "left_semi").where(bare), "evidence_locator_complete", "evidence_id"),
        tag(drafters.join(courts, ["law_work_id", "root"], "left_semi"), "drafter_intent_not_sole_truth"),
        tag(lost("from_revision").select("id").union(lost("to_revision").select("id")).distinct(), "no_substantive_without_resolved_lawtime"),
        tag(change.where((F.coalesce("rank", F.lit("normal")) != "normal") & c("rank_reason").isNull()), "rank_reason_present"),
        tag(claims.where(c("claim_support") & unsound), "lawtime_resolved_not_sufficient"),
        tag(timed.where(c("claim_support") & _no("_checked")), "unknown_or_unchecked_blocked"),
    ]
    return reduce(DataFrame.unionByName, gates)


def survival_gates(survivals: DataFrame, revisions: DataFrame) -> DataFrame:
    """Survivals of old law (id, formal_status, substantive_status, applicability_scope, superseding_revision_id): all three axes told, and the formal one as the law's revisions say."""
    axes = survivals.where("formal_status is null or substantive_status is null or applicability_scope is null or size(applicability_scope) = 0").select(F.lit("three_axes").alias("gate"), F.col("id").alias("key"))
    law = revisions.select(F.col("revision_id").alias("superseding_revision_id"), "law_id").distinct()
    state = formal_status(revisions).select("law_id", F.col("formal_status").alias("_state"))
    other = survivals.join(law, "superseding_revision_id").join(state, "law_id").where(F.col("formal_status") != F.col("_state")).select(F.lit("formal_status_consistent").alias("gate"), F.col("id").alias("key"))
    return axes.unionByName(other)


STATUTE_EDGES = ["cites_statute", "statute_ref", "applies_statute"]


def reference_gates(edges: DataFrame, revisions: DataFrame, evaluated: DataFrame, successions: DataFrame) -> DataFrame:
    """Violations of references in time: unknown times carry nothing, a revision covers its time, support needs a settled state, successions of one work do not overlap.

    ``edges``: edge_id, edge_type, as_of_basis, as_of_date, revision_id, temporal_status, temporal_caveat, claim_support; ``revisions``: revision_id, valid_from,
    valid_to; ``evaluated``: edge_id; ``successions``: succession_id, law_work_id, law_id, relation_type, confidence, valid_from, valid_to, lineage_event_id.
    """
    c = F.col
    tag = lambda df, gate, key="edge_id": df.select(F.lit(gate).alias("gate"), c(key).cast("string").alias("key"))
    cites = edges.where(c("edge_type").isin(STATUTE_EDGES))
    loose = cites.where((c("as_of_basis") == "unknown") & (c("as_of_date").isNotNull() | c("revision_id").isNotNull() | ~c("temporal_status").eqNullSafe("unchecked") | ~c("claim_support").eqNullSafe(False)))
    spans = revisions.select("revision_id", "valid_from", "valid_to")
    outside = edges.where("as_of_basis <> 'unknown' and as_of_date is not null").join(spans, "revision_id").where(F.coalesce(c("as_of_date") < c("valid_from"), F.lit(False)) | F.coalesce(c("as_of_date") >= c("valid_to"), F.lit(False)))
    weak = cites.where("claim_support").join(evaluated.select("edge_id").distinct().withColumn("_ev", F.lit(True)), "edge_id", "left").where(c("revision_id").isNull() | ~F.coalesce(c("temporal_status").isin("current", "superseded"), F.lit(False)) | (c("temporal_caveat") != "none") | c("_ev").isNull())
    s = successions.where("relation_type <> 'unknown' and confidence in ('reviewed', 'confirmed')")
    side = lambda n: s.select("law_work_id", *[c(x).alias(f"{x}{n}") for x in ("succession_id", "law_id", "valid_from", "valid_to", "lineage_event_id")])
    before = lambda x, y: c(x).isNull() | c(y).isNull() | (c(x) < c(y))
    twice = side(1).join(side(2), "law_work_id").where((c("succession_id1") < c("succession_id2")) & (c("law_id1") != c("law_id2")) & before("valid_from1", "valid_to2") & before("valid_from2", "valid_to1") & (~c("lineage_event_id1").eqNullSafe(c("lineage_event_id2")) | c("lineage_event_id1").isNull()))
    pair = twice.select(F.concat_ws("/", "succession_id1", "succession_id2").alias("pair"))
    return reduce(DataFrame.unionByName, [tag(loose, "unknown_is_unchecked"), tag(outside, "revision_covers_time"), tag(weak, "support_needs_settled_time"), tag(pair, "successions_do_not_overlap", "pair")])
