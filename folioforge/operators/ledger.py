"""Append-only ledgers: latest states, folds, chains, repairs and their inverses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_state(events: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """The last row of each key; a partial maximum, so only one row a key and task is shuffled."""
    return events.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("m")).select(key, *[F.col(f"m.{c}").alias(c) for c in cols])


def quarantine_fold(events: DataFrame, key: str, order: list[str], transition: str, epoch: str, reason: str) -> DataFrame:
    """Per key: is it open, since when and why, was it ever released, did it recur.

    enter and recur open, release closes, escape changes nothing. A recurrence is an explicit
    recur, or an enter after some release while not open.
    """
    w = Window.partitionBy(key).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    t = F.col(transition)
    moves = events.where(t.isin("enter", "recur", "release", "escape"))
    last = F.last(F.when(t.isin("enter", "recur", "release"), t), ignorenulls=True).over(before)
    seen = F.coalesce(F.max(F.when(t == "release", 1).otherwise(0)).over(before), F.lit(0)) == 1
    is_open = F.coalesce(last.isin("enter", "recur"), F.lit(False))
    marked = moves.withColumn("again", (t == "recur") | ((t == "enter") & seen & ~is_open)).withColumn("at", F.struct(*order))
    opens, closes = F.max(F.when(t.isin("enter", "recur"), F.struct("at", F.col(epoch).alias("e"), F.col(reason).alias("r")))), F.max(F.when(t == "release", F.col("at")))
    g = marked.groupBy(key).agg(opens.alias("o"), closes.alias("c"), F.max(F.when(t.isin("enter", "recur"), F.lit(True))).alias("entered"), F.max(t == "release").alias("released"), F.max("again").alias("recurred"), F.count_if(t == "escape").alias("escapes"), F.count(F.lit(1)).alias("entries"))
    held = F.col("o").isNotNull() & (F.col("c").isNull() | (F.col("o.at") > F.col("c")))
    return g.select(key, held.alias("open"), F.when(held, F.col("o.e")).alias("since"), F.when(held, F.col("o.r")).alias("reason"), F.coalesce("entered", F.lit(False)).alias("entered"), "released", "recurred", "escapes", "entries")


def quarantine_kpi(folded: DataFrame, now: float) -> DataFrame:
    """One row of figures; empty denominators count as one."""
    day = 86_400.0
    age = F.when(F.col("open"), F.greatest(F.lit(0.0), (F.lit(now) - F.col("since")) / day))
    n = lambda c: F.count_if(c)
    return folded.agg(
        F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), n(F.col("entered")).alias("distinct_items"), n(F.col("open")).alias("open_count"), n(F.col("released")).alias("released_count"),
        F.coalesce(F.avg(age), F.lit(0.0)).alias("mean_age_days"), F.coalesce(F.max(age), F.lit(0.0)).alias("max_age_days"), F.coalesce(F.sum("escapes"), F.lit(0)).alias("escape_events"),
        (F.coalesce(F.sum("escapes"), F.lit(0)) / F.greatest(n(F.col("entered")), F.lit(1))).alias("escape_rate"), (n(F.col("recurred")) / F.greatest(n(F.col("released")), F.lit(1))).alias("recurrence_rate"),
    )


def chain_breaks(ledger: DataFrame, group: str, order: str, body: list[str], prev: str, own: str) -> DataFrame:
    """The first row of each ledger whose stored hashes do not follow from the row before it."""
    w = Window.partitionBy(group).orderBy(order)
    before = F.coalesce(F.lag(own).over(w), F.lit(""))
    made = F.sha2(F.concat_ws("\x1f", F.col(prev), *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in body]), 256)
    bad = ledger.withColumn("_before", before).where((F.col(prev) != F.col("_before")) | (F.col(own) != made))
    return bad.groupBy(group).agg(F.min(order).alias("broken_at"))


def append_chained(last: DataFrame, new: DataFrame, group: str, order: str, body: list[str], prev: str, own: str) -> DataFrame:
    """New rows with ``prev`` and ``own`` hashes that go on from the last one of their ledger.

    ``last``: group, own (the ledger's last hash; a ledger that it lacks begins with empty text). A chain is a fold by nature: each
    ledger is one sorted run of rows that is walked once, row by row and without being held; ledgers go in parallel.
    """
    import hashlib
    from collections.abc import Iterator

    import pandas as pd

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in new.schema.fields]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\x01")).alias(f"_t{n}") for n, c in enumerate(body)]
    rows = new.select(*new.columns, *texts).join(last.select(group, F.col(own).alias("_last")), group, "left")

    cols, width = list(new.columns), len(body)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ledger, held = object(), ""
        for pdf in batches:
            before, after = [], []
            for row in pdf[[group, "_last", *[f"_t{n}" for n in range(width)]]].itertuples(index=False):
                if row[0] != ledger:
                    ledger, held = row[0], row[1] or ""
                before.append(held)
                held = hashlib.sha256("\x1f".join([held, *row[2:]]).encode()).hexdigest()
                after.append(held)
            yield pdf[cols].assign(**{prev: before, own: after})

    return rows.repartition(group).sortWithinPartitions(group, order).mapInPandas(run, ", ".join([*[f"`{k.split(' ', 1)[0]}` {k.split(' ', 1)[1]}" for k in kept], f"`{prev}` string", f"`{own}` string"]))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Old rows replaced or joined by new ones of their key; of several new rows of a key the greatest by ``order`` counts. Applied twice it changes nothing more."""
    cols = [c for c in old.columns if c not in keys]
    best = new.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("m")).select(*keys, *[F.col(f"m.{c}").alias(c) for c in cols])
    return old.join(best.select(*keys), keys, "left_anti").select(*old.columns).unionByName(best.select(*old.columns))


def append_only_breaches(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, rule)``: rows of an append-only table that were deleted or changed since an earlier state."""
    cols = [c for c in before.columns if c not in keys]
    digest = lambda df, n: df.select(*keys, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in cols]).alias(n))
    j = digest(before, "_b").join(digest(after, "_a"), keys, "left")
    return j.where(F.col("_a").isNull() | (F.col("_a") != F.col("_b"))).select(*keys, F.when(F.col("_a").isNull(), "deleted").otherwise("changed").alias("rule"))


def repair_manifest(plans: DataFrame, health_before: DataFrame, health_after: DataFrame, defects: DataFrame, key: str) -> DataFrame:
    """One row a repaired book: repairs by field, health before and after, new defects, and whether the plan may stand.

    ``defects`` comes from :func:`before_after`. Health that sinks or a new defect forbids it.
    """
    n = plans.groupBy(key).agg(F.count(F.lit(1)).alias("repairs"), F.array_sort(F.collect_set("field")).alias("fields"))
    fresh = defects.where("change = 'new'").groupBy(key).agg(F.count(F.lit(1)).alias("new_defects"))
    j = n.join(health_before.select(key, F.col("health").alias("before")), key, "left").join(health_after.select(key, F.col("health").alias("after")), key, "left").join(fresh, key, "left").na.fill(0, ["new_defects"])
    return j.withColumn("delta", F.col("after") - F.col("before")).withColumn("ok", F.coalesce((F.col("after") >= F.col("before")) & (F.col("new_defects") == 0), F.lit(False)))


def repair_plan(current: DataFrame, wanted: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """``(keys, field, before, after)`` for each value that differs; applying it twice changes nothing more."""
    both = current.alias("c").join(wanted.alias("w"), keys)
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"c.{f}").cast("string").alias("before"), F.col(f"w.{f}").cast("string").alias("after")) for f in fields]))
    return both.select(*keys, cell.alias("x")).select(*keys, "x.*").where(~F.col("before").eqNullSafe(F.col("after")) & F.col("after").isNotNull())


def apply_plan(current: DataFrame, plan: DataFrame, keys: list[str], fields: list[str], value: str = "after") -> DataFrame:
    """The table after a plan; with ``value='before'`` the plan is undone."""
    wide = plan.groupBy(*keys).agg(*[F.max(F.when(F.col("field") == f, F.struct(F.lit(1).alias("set"), F.col(value).alias("v")))).alias(f"_{f}") for f in fields])
    out = current.join(wide, keys, "left")
    return out.select(*[F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.v").cast(current.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in current.columns])


def versioned_upsert(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Old and new rows merged: new keys get version 1, a changed hash replaces and counts up, equal rows stay."""
    o, n = old.select(key, *cols, "row_hash", "version").alias("o"), new.select(key, *cols, "row_hash").alias("n")
    j = o.join(n, key, "full_outer")
    fresh = F.col("n.row_hash").isNotNull() & ~F.col("o.row_hash").eqNullSafe(F.col("n.row_hash"))
    return j.select(key, *[F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in [*cols, "row_hash"]], F.when(F.col("o.version").isNull(), 1).when(fresh, F.col("o.version") + 1).otherwise(F.col("o.version")).alias("version"))


def before_after(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """fixed, persisted or new for each defect of two runs."""
    b, a = before.select(*keys).distinct().withColumn("b", F.lit(True)), after.select(*keys).distinct().withColumn("a", F.lit(True))
    return b.join(a, keys, "full_outer").select(*keys, F.when(F.col("a").isNull(), "fixed").when(F.col("b").isNull(), "new").otherwise("persisted").alias("change"))


def violations(df: DataFrame, key: str, rules: dict[str, object]) -> DataFrame:
    """``(key, rule)`` for each rule a row breaks. A rule that is null counts as broken: gates fail closed."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]))
    return df.select(key, F.explode(broken).alias("rule"))


def reachability(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Transitive closure of a small dependency graph by doubling; ``a = b`` tells a cycle."""
    from folioforge.runtime import materialize

    reach = materialize(edges.select("a", "b").distinct(), "reach")
    n = reach.count()
    for _ in range(rounds):
        reach = materialize(reach.union(reach.alias("x").join(reach.alias("y"), F.col("x.b") == F.col("y.a")).select("x.a", "y.b")).distinct(), "reach")
        size = reach.count()
        if size == n:
            return reach
        n = size
    raise RuntimeError("closure did not settle")
