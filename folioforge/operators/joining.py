"""Joining of delivered outlines with those at hand: dry run, invariants, what an apply would do. Decisions are rows, never writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators.linkage import join_action

WRITES = ["create", "overwrite_simple"]


def dry_run(resolver: DataFrame, delivered: DataFrame, existing: DataFrame, known: DataFrame) -> DataFrame:
    """``(row_id, book_id, isbn, action, reason, new_nodes, existing_nodes, node_delta)``, one row a decision.

    ``resolver``: row_id, book_id, isbn, bucket; ``delivered``: book_id, n (nodes); ``existing``: isbn, state (null, 'simple', 'unreadable' or
    other), rich, protected, done, n; ``known``: isbn. An accepted decision is blocked by a missing id, a bad or unknown isbn, or an
    isbn with several books or a book with several isbns; it is skipped if nothing was delivered; what cannot be read goes to people.
    """
    auto = resolver.where("bucket = 'auto_accept' and book_id is not null and book_id <> '' and isbn is not null and isbn <> ''").select("book_id", "isbn").distinct()
    of_isbn, of_book = auto.groupBy("isbn").agg(F.count(F.lit(1)).alias("_books")), auto.groupBy("book_id").agg(F.count(F.lit(1)).alias("_isbns"))
    j = (
        resolver.join(of_isbn, "isbn", "left").join(of_book, "book_id", "left").join(known.select("isbn").distinct().withColumn("_known", F.lit(True)), "isbn", "left")
        .join(delivered.select("book_id", F.col("n").alias("new_nodes")), "book_id", "left").join(existing.withColumnRenamed("n", "existing_nodes"), "isbn", "left")
    )
    c = F.col
    blank = lambda x: F.coalesce(c(x), F.lit("")) == ""
    action = (
        F.when(~F.coalesce(c("bucket").isin("auto_accept", "human_review", "defer_new"), F.lit(False)), "skip_unknown_bucket")
        .when(c("bucket") == "defer_new", "defer_staging").when(c("bucket") == "human_review", "route_human_review")
        .when(blank("book_id"), "blocked_no_book_id").when(~F.coalesce(c("isbn").rlike(r"^97[89]\d{10}$"), F.lit(False)), "blocked_bad_isbn").when(c("_known").isNull(), "blocked_missing_isbn")
        .when(c("_books") > 1, "blocked_ambiguous_isbn").when(c("_isbns") > 1, "blocked_ambiguous_book").when(F.coalesce("new_nodes", F.lit(0)) == 0, "skip_empty_source")
        .when(c("state") == "unreadable", "route_human_review").otherwise(join_action(c("state"), c("rich"), c("protected"), c("done")))
    )
    j = j.withColumn("action", action)
    reason = (
        F.when(c("bucket") == "human_review", "resolver_human_review").when(c("action").startswith("blocked"), c("action")).when(c("bucket") == "defer_new", "no_canonical_match")
        .when(c("action") == "route_human_review", F.when(c("state") == "unreadable", "existing_unreadable").when(c("state") != "simple", "non_simple_status").when(c("protected"), "protected_source").when(c("rich"), "structurally_rich").otherwise("existing_protected"))
    )
    writes = c("action").isin(WRITES)
    return j.select("row_id", "book_id", "isbn", "action", reason.alias("reason"), F.coalesce("new_nodes", F.lit(0)).alias("new_nodes"), F.coalesce("existing_nodes", F.lit(0)).alias("existing_nodes"), F.when(writes, c("new_nodes") - F.coalesce("existing_nodes", F.lit(0))).alias("node_delta"))


def invariant_breaches(actions: DataFrame, existing: DataFrame) -> DataFrame:
    """Planned writes over outlines that are protected, rich, not simple or unreadable, and rows that came out more or less than once."""
    guard = F.coalesce(F.col("protected"), F.lit(False)) | F.coalesce(F.col("rich"), F.lit(False)) | (F.col("state") != "simple")
    bad = actions.where(F.col("action").isin(WRITES)).join(existing.where(guard).select("isbn"), "isbn", "left_semi").select("row_id", F.lit("protected_overwrite").alias("rule"))
    twice = actions.groupBy("row_id").count().where("count > 1").select("row_id", F.lit("row_counted_twice").alias("rule"))
    return bad.unionByName(twice)


def apply_status(actions: DataFrame, existing: DataFrame, whitelist: DataFrame | None, commit: bool) -> DataFrame:
    """``(row_id, isbn, action, status)`` of the planned writes.

    A commit that would overwrite needs a whitelist: without one nothing is applied. With one, isbns outside need
    approval. What is protected by now is refused. No whitelist and an empty one are not the same.
    """
    plans = actions.where(F.col("action").isin(WRITES)).select("row_id", "isbn", "action")
    overwrites = plans.where("action = 'overwrite_simple'").groupBy().agg((F.count(F.lit(1)) > 0).alias("_any"))
    guard = F.coalesce(F.col("protected"), F.lit(False)) | F.coalesce(F.col("rich"), F.lit(False)) | (F.col("state") != "simple")
    j = plans.crossJoin(F.broadcast(overwrites)).join(existing.where(guard).select("isbn").distinct().withColumn("_guard", F.lit(True)), "isbn", "left")
    if whitelist is not None:
        j = j.join(whitelist.select("isbn").distinct().withColumn("_listed", F.lit(True)), "isbn", "left")
    refused = F.lit(commit and whitelist is None) & F.col("_any")
    unlisted = F.col("_listed").isNull() if whitelist is not None else F.lit(False)
    status = F.when(refused, "refused_overwrite_needs_whitelist").when(unlisted, "needs_approval").when(F.col("_guard"), "refused_protected").otherwise("written" if commit else "would_write")
    return j.select("row_id", "isbn", "action", status.alias("status"))


# The conditions of an apply, in their order.
GATES = ["whitelist_required", "no_unresolved_conflict", "edition_identity_resolved", "pdf_authority_qualified", "rollback_bundle_present", "decision_log_append_only", "all_nodes_accounted_for"]


def apply_guard(requests: DataFrame, whitelist: DataFrame | None) -> DataFrame:
    """``(isbn, allowed, refusals, passed)``: seven conditions, and what is unknown refuses.

    ``requests``: isbn, unresolved_conflicts, edition_identity_status, uses_pdf_authority, pdf_qualified, rollback_bundle, log_append_only,
    nodes_accounted. Without a whitelist nothing is on it.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    j = requests.join(whitelist.select("isbn").distinct().withColumn("_listed", F.lit(True)), "isbn", "left") if whitelist is not None else requests.withColumn("_listed", F.lit(False))
    holds = [yes("_listed"), F.coalesce("unresolved_conflicts", F.lit(0)) <= 0, F.coalesce(F.col("edition_identity_status").isin("resolved_same_manifestation", "manual_resolved"), F.lit(False)), ~yes("uses_pdf_authority") | yes("pdf_qualified"), yes("rollback_bundle"), yes("log_append_only"), yes("nodes_accounted")]
    refusals = F.array_compact(F.array(*[F.when(~h, F.lit(g)) for g, h in zip(GATES, holds)]))
    return j.select("isbn", (F.size(refusals) == 0).alias("allowed"), refusals.alias("refusals"), F.array_except(F.array(*[F.lit(g) for g in GATES]), refusals).alias("passed"))


def guard_rollup(guarded: DataFrame) -> DataFrame:
    """``(gate, refused)``: how many requests each condition refuses, and ``allowed`` for those that pass."""
    refused = guarded.select(F.explode("refusals").alias("gate")).groupBy("gate").agg(F.count(F.lit(1)).alias("n"))
    return refused.unionByName(guarded.where("allowed").groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("allowed").alias("gate"), "n"))
