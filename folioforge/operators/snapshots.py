"""What changed between consecutive full snapshots, by invertible Bloom lookup tables.

Every run's records become (key, value digest) pairs spread over hash buckets, and
are written once, slim and placed by bucket. A bucket keeps, per run, a small table
of cells with a count and XOR sums; as a bucket's records lie together, its cells are
summed within the task that reads them, and only cells go through the shuffle.
Subtracting the tables of two consecutive runs leaves
the differing pairs, which are peeled out cell by cell, all pure cells of a round at once. A bucket that does not
peel, or whose recovered pairs do not add up to the difference of the bucket
digests, is rebuilt with more cells; one that fails at the last size is taken
over whole. The recovered keys are then classified by an exact join of just
those keys' rows, so a collision can never invent a change.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioforge.runtime import checked_broadcast, materialize, partitions_for

HASHES = 3
#: slim rows that one task places; a task then reads whole buckets
PLACED_ROWS = 2_000_000
_CELL = "pair int, bucket long, cell int, n long, kx long, vx long, cx long"


def record_key(col: Column) -> Column:
    """Trimmed (all kinds of blanks), upper-case id; null where nothing is left."""
    bare = F.regexp_replace(col, r"^[\s\p{Z}\x{200b}-\x{200d}\x{feff}]+|[\s\p{Z}\x{200b}-\x{200d}\x{feff}]+$", "")
    return F.when(F.length(bare) > 0, F.upper(bare))


def hash_value(col: Column) -> Column:
    """Hash text without notation: no algorithm prefix, blanks or separators, lower case."""
    low = F.lower(F.regexp_replace(col, r"[\s\p{Z}]", ""))
    bare = F.regexp_replace(F.regexp_replace(low, r"^(?:[a-z0-9]+[:=]|0x)", ""), r"[^0-9a-z]", "")
    return F.when(F.length(bare) > 0, bare)


def latest_records(df: DataFrame, key: str, run: str, at: str, digest: str) -> DataFrame:
    """``(run, key, h1, h2, c1, c2)``: the latest row of each record and run.

    ``h1, h2`` are 128 bits of the hash value (null without one), ``c1, c2`` of all columns but
    the key, run, time and hash. Of rows with the same time the greatest digests count, so repeated rows are one.
    """
    rest = sorted(c for c in df.columns if c not in {key, run, at, digest})
    # to_json keeps nulls apart from empty text and covers arrays, maps and structs
    content = F.to_json(F.struct(*[_ordered(df, c) for c in rest]), {"ignoreNullFields": "false"}) if rest else F.lit("")
    slim = df.select(F.col(run).alias("run"), record_key(F.col(key)).alias("key"), F.col(at).alias("at"), hash_value(F.col(digest)).alias("hashed"), content.alias("content")).where("run is not null and key is not null")
    bits = lambda c, n: F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(n), c))
    return (
        slim.select("run", "key", "at", bits("hashed", 1).alias("h1"), bits("hashed", 2).alias("h2"), bits("content", 1).alias("c1"), bits("content", 2).alias("c2"))
        .groupBy("run", "key").agg(F.max(F.struct("at", "h1", "h2", "c1", "c2")).alias("m")).select("run", "key", "m.h1", "m.h2", "m.c1", "m.c2")
    )


def _ordered(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    return (F.array_sort(F.map_entries(col)) if isinstance(kind, T.MapType) else col).alias(name)


def _cells(elements: DataFrame, size: Column) -> DataFrame:
    """XOR cells of each (pair, side, bucket): ``size`` cells for each of the HASHES sub-tables."""
    place = [(F.lit(i) * size + F.pmod(F.xxhash64(F.lit(i), "k"), size)).cast("int") for i in range(HASHES)]
    return (
        elements.withColumn("cell", F.explode(F.array(*place)))
        .groupBy("pair", "bucket", "cell")
        # both sides go into one table: XOR subtracts by itself, the count by its sign
        .agg(F.sum("side").alias("n"), F.expr("bit_xor(k)").alias("kx"), F.expr("bit_xor(v)").alias("vx"), F.expr("bit_xor(c)").alias("cx"))
    )


def _peel(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pair, bucket = int(pdf["pair"].iloc[0]), int(pdf["bucket"].iloc[0])
        total = size * HASHES
        n, kx, vx, cx = (np.zeros(total, dtype=np.int64) for _ in range(4))
        at = pdf["cell"].to_numpy()
        n[at], kx[at], vx[at], cx[at] = (pdf[x].to_numpy() for x in ("n", "kx", "vx", "cx"))
        # the bucket's digest: every pair stands once in the first sub-table
        want = [np.bitwise_xor.reduce(x[:size]) for x in (kx, vx, cx)]
        got = [np.int64(0)] * 3
        out: list[np.ndarray] = []
        # a table that peels does so in a few rounds; each round takes all that stand alone
        for _ in range(total + 1):
            pure = np.flatnonzero((n == 1) | (n == -1))
            pure = pure[_check_of(kx[pure], vx[pure]) == cx[pure]]
            if not len(pure):
                break
            _, first = np.unique(np.stack([kx[pure], vx[pure]]), axis=1, return_index=True)
            pure = pure[first]
            k, v, c, side = kx[pure], vx[pure], cx[pure], n[pure]
            out.append(k)
            got = [g ^ np.bitwise_xor.reduce(x) for g, x in zip(got, (k, v, c))]
            for slot in _slots(k, size):
                np.subtract.at(n, slot, side)
                for sums, x in ((kx, k), (vx, v), (cx, c)):
                    np.bitwise_xor.at(sums, slot, x)
        ok = not (n.any() or kx.any() or vx.any() or cx.any()) and got == want
        keys = np.unique(np.concatenate(out)) if ok and out else np.zeros(0 if ok else 1, dtype=np.int64)
        return pd.DataFrame({"pair": pair, "bucket": bucket, "k": keys, "ok": ok}, index=range(len(keys)))

    return run


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _xx_int(value: int, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int."""
    h = (seed + _P5 + np.uint64(4)) ^ (np.uint64(value) * _P1)
    return _mixed(_rotl(h, 23) * _P2 + _P3)


def _xx_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of longs."""
    h = (seed + _P5 + np.uint64(8)) ^ (_rotl(value.astype(np.uint64) * _P2, 31) * _P1)
    return _mixed(_rotl(h, 27) * _P1 + _P4)


def _slots(k: np.ndarray, size: int) -> list[np.ndarray]:
    """The cell of each key in each sub-table."""
    with np.errstate(over="ignore"):
        seed = np.full(1, 42, dtype=np.uint64)
        return [i * size + _xx_long(k, _xx_int(i, seed)).astype(np.int64) % size for i in range(HASHES)]


def _check_of(k: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The pairs' check sums: Spark's xxhash64(k, v)."""
    with np.errstate(over="ignore"):
        return _xx_long(v, _xx_long(k, np.full(len(k), 42, dtype=np.uint64))).astype(np.int64)


def snapshot_changes(
    df: DataFrame, runs: DataFrame, *, key: str, run: str, at: str, digest: str, run_at: str,
    per_bucket: int = 2048, cells: int = 64, rounds: int = 3,
) -> DataFrame:
    """``(run, key, change_type)`` for each run but the first against the run before it.

    ``runs`` lists the runs (bounded: one row a delivery) with ``run_at`` giving
    their order. Rows without a key or of an unlisted run are no record. 'changed'
    means other hash values, or, where a hash is missing on either side, other
    contents. An empty table or a single run gives no rows; a listed run without
    records makes every record of the run before 'removed'. Column names of
    ``df`` are free: clashing extra columns only enter the content digest.

    ``per_bucket`` records share a bucket that starts with ``cells`` cells per
    sub-table; failed buckets grow eightfold at most ``rounds`` times and are
    then compared whole, so the result never depends on these sizes.
    """
    spark = df.sparkSession
    order = runs.where(F.col(run).isNotNull()).groupBy(F.col(run).alias("run")).agg(F.max(run_at).alias("t"))
    order = order.select("run", (F.row_number().over(Window.orderBy("t", "run")) - 1).alias("seq"))
    last = order.agg(F.max("seq")).first()[0]
    names = order.withColumnRenamed("seq", "pair")
    # rows, not records, so that the number is known without a pass; repeated rows only make buckets smaller
    buckets = max(1, -(-df.count() // ((last or 0) * per_bucket + per_bucket)))
    tagged = latest_records(df, key, run, at, digest).join(F.broadcast(order), "run").drop("run").withColumn("k", F.xxhash64("key"))
    value = F.when(F.col("h1").isNotNull(), F.xxhash64(F.lit("h"), "h1", "h2")).otherwise(F.xxhash64(F.lit("c"), "c1", "c2"))
    placed = tagged.withColumn("v", value).withColumn("bucket", F.pmod(F.xxhash64(F.lit(7), "k"), F.lit(buckets)))
    parts = min(buckets, partitions_for(buckets * per_bucket, PLACED_ROWS, spark))
    records = materialize(placed.repartition(parts, "bucket"), "snapshot")
    if not last or records.isEmpty():
        return records.select(F.lit("").alias("run"), "key", F.lit("").alias("change_type")).limit(0)
    sides = F.array(F.struct(F.col("seq").alias("pair"), F.lit(1).alias("side")), F.struct((F.col("seq") + 1).alias("pair"), F.lit(-1).alias("side")))
    elements = (
        records.select("k", "v", F.xxhash64("k", "v").alias("c"), "bucket", F.explode(sides).alias("s"))
        .select("k", "v", "c", "bucket", "s.pair", F.col("s.side").cast("long").alias("side"))
        .where((F.col("pair") >= 1) & (F.col("pair") <= last))
    )
    found, open_buckets, size = None, None, cells
    for _ in range(rounds):
        part = elements if open_buckets is None else elements.join(open_buckets, ["pair", "bucket"], "left_semi")
        live = _cells(part, F.lit(size)).where("n <> 0 or kx <> 0 or vx <> 0 or cx <> 0")
        peeled = materialize(live.groupBy("pair", "bucket").applyInPandas(_peel(size), "pair int, bucket long, k long, ok boolean"), "peeled")
        good = peeled.where("ok").select("pair", "k")
        found = good if found is None else found.union(good)
        open_buckets = peeled.where("not ok").select("pair", "bucket").distinct()
        if open_buckets.isEmpty():
            open_buckets = None
            break
        size *= 8
    if open_buckets is not None:
        found = found.union(elements.join(open_buckets, ["pair", "bucket"], "left_semi").select("pair", "k"))
    found = found.distinct()
    # only the recovered keys' rows are joined: exact classification
    wanted = checked_broadcast(materialize(found, "found"))
    mine = records.join(checked_broadcast(wanted.select("k").distinct()), "k", "left_semi")
    states = F.array(F.struct(F.col("seq").alias("pair"), F.lit(1).alias("now")), F.struct((F.col("seq") + 1).alias("pair"), F.lit(0).alias("now")))
    both = mine.select("k", "key", "h1", "h2", "c1", "c2", F.explode(states).alias("s")).select("k", "key", "s.pair", "s.now", F.struct("h1", "h2").alias("h"), F.struct("c1", "c2").alias("c"))
    side = lambda name, now: F.max(F.when(F.col("now") == now, F.col(name)))
    both = (
        both.join(wanted, ["pair", "k"], "left_semi").groupBy("pair", "key")
        .agg(F.max(F.col("now") == 1).alias("is_now"), F.max(F.col("now") == 0).alias("was"), side("h", 1).alias("h1"), side("h", 0).alias("h0"), side("c", 1).alias("c1"), side("c", 0).alias("c0"))
    )
    differs = F.when(F.col("h1.h1").isNotNull() & F.col("h0.h1").isNotNull(), F.col("h1") != F.col("h0")).otherwise(F.col("c1") != F.col("c0"))
    kind = F.when(~F.col("was"), "added").when(~F.col("is_now"), "removed").when(differs, "changed")
    return both.withColumn("change_type", kind).where("change_type is not null").join(F.broadcast(names), "pair").select("run", "key", "change_type")
