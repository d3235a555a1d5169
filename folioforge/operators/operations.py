"""Work in progress as data: stages, requests and results, lanes, observations, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.runtime import materialize


def nearest_of_kind(nodes: DataFrame, key: str, parent: str, kind: str, wanted: str) -> DataFrame:
    """``(key, section)``: the nearest node of a kind on the way up, the node itself included; null if there is none.

    Pointers double each round, so a chain of n needs log n joins; cycles end with the rounds.
    """
    state = materialize(nodes.select(key, F.when(F.col(kind) == wanted, F.col(key)).alias("hit"), F.col(parent).alias("up")), "up")
    rounds = max(1, state.count().bit_length() + 1)
    for _ in range(rounds):
        waiting = state.where("hit is null and up is not null")
        if waiting.isEmpty():
            break
        far = state.select(F.col(key).alias("up"), F.col("hit").alias("far_hit"), F.col("up").alias("far_up"))
        moved = waiting.join(far, "up", "left").select(key, F.col("far_hit").alias("hit"), F.col("far_up").alias("up"))
        state = materialize(state.where("hit is not null or up is null").unionByName(moved), "up")
    return state.select(key, F.col("hit").alias("section"))


def round_trips(requests: DataFrame, results: DataFrame) -> DataFrame:
    """``(request_id, result_file, matched_by, state)``: by request id, else stem, else the expected file; unmatched results are orphans.

    ``requests``: request_id, stem, expected; ``results``: result_file, request_id, stem.
    """
    r = requests.select("request_id", "stem", "expected")
    one = lambda c, k: results.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(k)).agg(F.min("result_file").alias(f"by_{k}"))
    j = r.join(one("request_id", "request_id"), "request_id", "left").join(one("stem", "stem"), "stem", "left").join(one("result_file", "expected"), "expected", "left")
    got = F.coalesce("by_request_id", "by_stem", "by_expected")
    how = F.when(F.col("by_request_id").isNotNull(), "request_id").when(F.col("by_stem").isNotNull(), "stem").when(F.col("by_expected").isNotNull(), "expected")
    matched = j.select("request_id", got.alias("result_file"), how.alias("matched_by"), F.when(got.isNull(), "pending").otherwise("answered").alias("state"))
    lone = results.join(matched.select("result_file"), "result_file", "left_anti").select(F.lit(None).cast("string").alias("request_id"), "result_file", F.lit(None).cast("string").alias("matched_by"), F.lit("orphan").alias("state"))
    return matched.unionByName(lone)


def stage_status(stages: DataFrame, deps: DataFrame) -> DataFrame:
    """``(stage, status)``: error, else blocked by a dependency that is not done, else done, waiting, in_progress or todo.

    ``stages``: stage, errors, ratio (of the probe), open_requests; ``deps``: stage, needs. A status depends on
    those before it, so the rounds go on until none changes; a status only ever turns to blocked, so there are no more
    rounds than stages.
    """
    own = F.when(F.col("errors") > 0, "error").when(F.col("ratio") >= 1, "done").when(F.col("open_requests") > 0, "waiting").when(F.col("ratio") > 0, "in_progress").otherwise("todo")
    state = materialize(stages.select("stage", own.alias("own"), own.alias("status")), "stages")
    for _ in range(state.count() + 1):
        unmet = deps.join(state.select(F.col("stage").alias("needs"), F.col("status").alias("s")), "needs", "left").where("coalesce(s, 'missing') <> 'done'").select("stage").distinct().withColumn("held", F.lit(True))
        fresh = state.join(unmet, "stage", "left").select("stage", "own", F.when(F.col("own") == "error", "error").when(F.col("held"), "blocked").otherwise(F.col("own")).alias("new"), "status")
        fresh = materialize(fresh, "stages")
        moved = not fresh.where("new <> status").isEmpty()
        state = fresh.select("stage", "own", F.col("new").alias("status"))
        if not moved:
            break
    return state.select("stage", "status")


def staged_append(new: DataFrame, existing: DataFrame, key: str, order: list) -> DataFrame:
    """The rows to append: new keys only, each once."""
    fresh = new.join(existing.select(key), key, "left_anti")
    return fresh.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def resend_candidates(decisions: DataFrame, status: str, bucket: str) -> DataFrame:
    """Accepted links that look like another edition, and deferred ones that look the same."""
    why = F.when((F.col(bucket) == "auto_accept") & F.col(status).startswith("suspected"), "auto_accept_false_positive").when((F.col(bucket) == "defer_new") & F.col(status).startswith("same"), "defer_new_recall_miss")
    return decisions.withColumn("why", why).where("why is not null")


def adopt_observations(observations: DataFrame, keys: list[str], *, value: str, family: str, priority: str, at: str, obs: str) -> DataFrame:
    """One value for each item and attribute, with its status and every observation that backs it.

    Observations of one family count once (its latest). The best priority wins, then the latest, then the
    least value. single_authority: one family; corroborated: several agree; disputed: they do not.
    """
    latest = observations.where(F.col(value).isNotNull()).groupBy(*keys, family).agg(F.max(F.struct(at, priority, value, obs)).alias("o")).select(*keys, family, "o.*")
    best = F.min(F.struct(F.col(priority).alias("p"), (-F.unix_micros(F.col(at).cast("timestamp"))).alias("t"), F.col(value).alias("v")))["v"]
    g = latest.groupBy(*keys).agg(best.alias("adopted"), F.count_distinct(family).alias("families"), F.count_distinct(value).alias("n_values"), F.collect_list(F.struct(F.col(value).alias("v"), F.col(obs).alias("o"))).alias("all"))
    status = F.when(F.col("families") == 1, "single_authority").when(F.col("n_values") == 1, "corroborated").otherwise("disputed")
    backing = F.array_sort(F.transform(F.filter("all", lambda x: x["v"] == F.col("adopted")), lambda x: x["o"]))
    return g.select(*keys, "adopted", status.alias("status"), "families", backing.alias("contributor_obs"))


def rank_replace(old_rank: Column, new_rank: Column, manual: Column) -> Column:
    """create, skip_manual, replace, append_missing or skip_lower by the sources' ranks (less is better)."""
    return F.when(old_rank.isNull(), "create").when(F.coalesce(manual, F.lit(False)), "skip_manual").when(new_rank < old_rank, "replace").when(new_rank == old_rank, "append_missing").otherwise("skip_lower")


def confusion(rows: DataFrame, predicted: Column, truth: Column) -> DataFrame:
    """Counts, precision, recall of a yes-or-no decision; null where a denominator is zero."""
    p, t = F.coalesce(predicted, F.lit(False)), F.coalesce(truth, F.lit(False))
    g = rows.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"))
    z = lambda n, d: F.round(F.col(n) / F.nullif(d, F.lit(0)), 4)
    return g.withColumn("precision", z("tp", F.col("tp") + F.col("fp"))).withColumn("recall", z("tp", F.col("tp") + F.col("fn")))


def drift(stored: DataFrame, made: DataFrame) -> DataFrame:
    """Rows that only one of two views has, with multiplicities."""
    return stored.exceptAll(made).withColumn("side", F.lit("stored")).unionByName(made.exceptAll(stored).withColumn("side", F.lit("made")))


#: which moves of a task are allowed: state before, move, state after
TRANSITIONS = [("inbox", "claim", "doing"), ("doing", "complete", "done"), ("doing", "block", "blocked"), ("blocked", "claim", "doing"), ("doing", "release", "inbox")]


def task_states(moves: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``(key, n, move, state, ok)``: each move and whether the state before it allows it.

    The state before a move follows from the move before, so one lag over the log is enough.
    """
    after = F.create_map(*[F.lit(x) for m, s in {m: s for _, m, s in TRANSITIONS}.items() for x in (m, s)])
    w = Window.partitionBy(key).orderBy(*order)
    before = F.coalesce(after[F.lag("move").over(w)], F.lit("inbox"))
    allowed = F.concat_ws(">", before, F.col("move")).isin([f"{b}>{m}" for b, m, _ in TRANSITIONS])
    return moves.select(key, F.row_number().over(w).alias("n"), "move", after[F.col("move")].alias("state"), allowed.alias("ok"))


def active_observations(observations: DataFrame, obs: str, supersedes: str, fetched: str, as_of) -> DataFrame:
    """Observations known at ``as_of`` that no other known one supersedes."""
    known = observations.where(F.col(fetched) <= F.lit(as_of))
    return known.join(known.where(F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(obs)).distinct(), obs, "left_anti")


def dispute_triage(a: Column, b: Column, plain_a: Column, plain_b: Column, definition: Column, edition_apart: Column, owner_attr: Column) -> Column:
    """Why two values of one attribute differ, first rule that holds; equal values have none."""
    on = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(a.eqNullSafe(b), F.lit(None)).when(plain_a == plain_b, "equivalent_after_normalization").when(on(definition), "definition_difference_allowed")
        .when(on(edition_apart), "edition_suspected").when(on(owner_attr), "needs_owner_policy").otherwise("true_conflict")
    )


def confirmed(evidence: DataFrame, keys: list[str], family: str, least: int = 2) -> DataFrame:
    """Claims that ``least`` independent families back; several fields of one family count once."""
    g = evidence.where(F.col(family).isNotNull()).groupBy(*keys).agg(F.count_distinct(family).alias("families"))
    return g.withColumn("confirmed", F.col("families") >= least)


def weighted_evidence(signals: dict[str, tuple[Column, float]]) -> tuple[Column, Column]:
    """``(for, against)``: sums of the weights of signals that hold, positive and negative apart."""
    hit = lambda c, w: F.when(F.coalesce(c, F.lit(False)), F.lit(float(w))).otherwise(0.0)
    pro = sum((hit(c, w) for c, w in signals.values() if w > 0), F.lit(0.0))
    con = sum((hit(c, -w) for c, w in signals.values() if w < 0), F.lit(0.0))
    return pro, con


def publications(nested: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(articles, authorships)`` of nested records: ``title``, ``ids`` (type, value), ``authors`` (name, nrid).

    An article keeps all its ids and one of each known type; an authorship has its place in the list.
    """
    of = lambda t: F.try_element_at(F.transform(F.filter("ids", lambda x: x["type"] == t), lambda x: x["value"]), F.lit(1))
    articles = nested.select(key, "title", of("DOI").alias("doi"), of("NAID").alias("naid"), "ids")
    authors = nested.select(key, F.posexplode("authors").alias("n", "a")).select(key, (F.col("n") + 1).alias("position"), F.col("a.name").alias("name"), F.col("a.nrid").alias("nrid"))
    return articles, authors


CITATION_LINE = r"^\s*(.+?)[「『](.+?)[」』]\s*([^\s0-9０-９]+)\s*([0-9０-９]+)巻([0-9０-９]+)号\s*([0-9０-９]+)頁(?:[（(]((?:19|20)[0-9]{2})年?[）)])?"


def commentary_lines(df: DataFrame, text: str) -> DataFrame:
    """Authors, title, journal, volume, issue, page and year of commentary citations; other lines are parsed false."""
    from folioforge.functions.text import narrow

    t = narrow(F.col(text))
    g = lambda k: F.regexp_extract(t, CITATION_LINE, k)
    i = lambda k: F.nullif(g(k), F.lit("")).try_cast("int")
    return df.select("*", (g(1) != "").alias("parsed"), F.filter(F.split(g(1), r"[・,、＝=]"), lambda x: x != "").alias("authors"), g(2).alias("title"), g(3).alias("journal"), i(4).alias("volume"), i(5).alias("issue"), i(6).alias("page"), i(7).alias("year"))
