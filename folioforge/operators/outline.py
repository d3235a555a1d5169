"""Outlines as ordered rows: clamped depths, parents, path numbers, granularity.

What a row needs of the rows before it is a small state (a count, a least value, the last
row of each level). Outlines are cut into chunks by their leading order column; a chunk
is summed up in one row, the states before each chunk come from a window over those
rows, and only a chunk's own rows are ever sorted together. So an outline that holds a
tenth of the table is as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: canonical outlines have at most so many levels
LEVELS = 6
#: values of the leading order column that share a chunk
CHUNK = 20_000


def _chunked(nodes: DataFrame, order: list[str], size: int) -> DataFrame:
    return nodes.withColumn("_chunk", F.floor(F.coalesce(F.col(order[0]).cast("double"), F.lit(-1.0)) / size))


def clamp_levels(nodes: DataFrame, group: list[str], order: list[str], level: str, out: str = "depth", size: int | None = None) -> DataFrame:
    """Depths that never jump by more than one level downwards.

    The rule reads depth = min(level - least level + 1, depth before + 1). Unrolled it is
    the running minimum of (level - place) plus the place, so a count and a least
    value are all that a chunk hands on. The leading order column is a number.
    """
    rows = _chunked(nodes, order, size or CHUNK)
    w = Window.partitionBy(*group, "_chunk").orderBy(*order)
    rows = rows.withColumn("_place", F.row_number().over(w))
    rows = rows.withColumn("_least", F.min(F.col(level) - F.col("_place")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sums = rows.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("n"), F.min(F.col(level) - F.col("_place")).alias("least"), F.min(level).alias("lo"))
    chunks = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("n").over(chunks), F.lit(0)))
    sums = sums.withColumn("_carry", F.min(F.col("least") - F.col("_before")).over(chunks)).withColumn("_lo", F.min("lo").over(Window.partitionBy(*group)))
    rows = rows.join(sums.select(*group, "_chunk", "_before", "_carry", "_lo"), [*group, "_chunk"])
    place = F.col("_place") + F.col("_before")
    least = F.least(F.col("_least") - F.col("_before"), F.col("_carry")) - F.col("_lo") + 1
    return rows.withColumn(out, F.least(least + place, place)).select(*[c for c in nodes.columns if c != out], out)


def parents(nodes: DataFrame, group: list[str], order: list[str], key: str, depth: str, levels: int = LEVELS, size: int | None = None) -> DataFrame:
    """Adds ``parent``: the nearest row before that is shallower; null for none.

    A chunk hands on the last row of each level; a row's parent is the latest of the shallower levels.
    """
    rows = _chunked(nodes, order, size or CHUNK).withColumn("_at", F.struct(*order, F.col(key).alias("_key")))
    w = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = lambda d: F.when(F.col(depth) == d, F.col("_at"))
    levels_above = range(1, levels)
    sums = rows.groupBy(*group, "_chunk").agg(*[F.max(on(d)).alias(f"_m{d}") for d in levels_above])
    chunks = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "_chunk", *[F.max(f"_m{d}").over(chunks).alias(f"_c{d}") for d in levels_above])
    rows = rows.withColumns({f"_l{d}": F.max(on(d)).over(w) for d in levels_above}).join(sums, [*group, "_chunk"])
    shallower = [F.when(F.col(depth) > d, F.coalesce(f"_l{d}", f"_c{d}")) for d in levels_above]
    return rows.withColumn("parent", F.greatest(*shallower)["_key"]).select(*nodes.columns, "parent")


def path_numbers(nodes: DataFrame, group: list[str], order: list[str], depth: str, levels: int = LEVELS, size: int | None = None) -> DataFrame:
    """Adds ``path_no``: c01 for roots, .02 for each level below, by ordinals among siblings.

    A row's ordinal at a depth counts the rows of that depth since the last shallower
    row. A chunk hands on, for each depth, how many it has after its last shallower row, and whether it has one.
    """
    rows = _chunked(nodes, order, size or CHUNK)
    w = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    every = range(1, levels + 1)
    # a new block of depth d begins with each row shallower than d
    rows = rows.withColumns({f"_b{d}": F.sum(F.when(F.col(depth) < d, 1).otherwise(0)).over(w) for d in every})
    rows = rows.withColumns({f"_s{d}": F.sum(F.when(F.col(depth) == d, 1).otherwise(0)).over(w) for d in every})
    # rows of the depth up to the block's beginning: the count when the block number last rose
    begun = lambda d: F.max(F.when(F.col(depth) < d, F.col(f"_s{d}"))).over(w)
    rows = rows.withColumns({f"_n{d}": F.col(f"_s{d}") - F.coalesce(begun(d), F.lit(0)) for d in every})
    last = F.max_by(F.struct(*[F.struct(f"_b{d}", f"_n{d}").alias(f"d{d}") for d in every]), F.struct(*order))
    sums = rows.groupBy(*group, "_chunk").agg(last.alias("_end")).select(*group, "_chunk", *[F.col(f"_end.d{d}._n{d}").alias(f"_t{d}") for d in every], *[(F.col(f"_end.d{d}._b{d}") > 0).cast("int").alias(f"_h{d}") for d in every])
    chunks = Window.partitionBy(*group).orderBy("_chunk")
    upto = chunks.rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumns({f"_g{d}": F.sum(f"_h{d}").over(upto) for d in every})
    sums = sums.withColumns({f"_u{d}": F.sum(f"_t{d}").over(Window.partitionBy(*group, f"_g{d}").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)) for d in every})
    sums = sums.select(*group, "_chunk", *[F.coalesce(F.lag(f"_u{d}").over(chunks), F.lit(0)).alias(f"_c{d}") for d in every])
    rows = rows.join(sums, [*group, "_chunk"])
    ordinal = lambda d: (F.col(f"_n{d}") + F.when(F.col(f"_b{d}") == 0, F.col(f"_c{d}")).otherwise(0)).cast("int")
    parts = [F.when(F.col(depth) >= d, F.format_string("c%02d" if d == 1 else "%02d", ordinal(d))) for d in every]
    return rows.withColumn("path_no", F.concat_ws(".", *parts)).select(*nodes.columns, "path_no")


def granularity(nodes: DataFrame, group: list[str], depth: str, page: str) -> DataFrame:
    """Deepest level, rows, share of rows with a page (four places): compared in this order."""
    return nodes.groupBy(*group).agg(
        F.max(depth).alias("max_depth"), F.count(F.lit(1)).alias("n_nodes"), F.round(F.count(page) / F.count(F.lit(1)), 4).alias("page_coverage")
    )


def shallow(depth: Column) -> Column:
    """As an aggregate: an outline whose rows all lie at the top."""
    return F.coalesce(F.max(depth) <= 1, F.lit(False))


def node_ids(nodes: DataFrame, isbn: str, order: list[str], size: int | None = None, prefix: str = "book:isbn") -> DataFrame:
    """Adds ``node_id``: ``{prefix}:{isbn}:toc:{place from 001}``, places counted over chunks."""
    rows = _chunked(nodes, order, size or CHUNK)
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy(isbn, "_chunk").orderBy(*order)))
    sums = rows.groupBy(isbn, "_chunk").agg(F.count(F.lit(1)).alias("n"))
    sums = sums.select(isbn, "_chunk", F.coalesce(F.sum("n").over(Window.partitionBy(isbn).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rows = rows.join(sums, [isbn, "_chunk"])
    return rows.withColumn("node_id", F.format_string(f"{prefix}:%s:toc:%03d", F.col(isbn), (F.col("_place") + F.col("_before")).cast("int"))).select(*nodes.columns, "node_id")


def structurally_rich(depth: Column, parent: Column, path: Column, page: Column) -> Column:
    """A row that shows structure: below the top, a parent, a nested path number or a page (0 counts)."""
    some = lambda c: F.coalesce(c, F.lit(False))
    return some(depth > 1) | some(parent != "") | some(path.rlike(r"[.\-]")) | page.isNotNull()


def nested_rows(df: DataFrame, children: str, levels: int, key: str) -> DataFrame:
    """Pre-order rows of a nested array of structs with ``title`` and ``children``, down to ``levels``.

    Each level is one ``posexplode``; the positions down the path are the order.
    """
    level = df.select(key, F.posexplode(children).alias("p0", "node")).select(key, F.array("p0").alias("at"), "node")
    out = None
    for d in range(1, levels + 1):
        rows = level.select(key, "at", F.lit(d).alias("depth"), F.col("node.title").alias("title"))
        out = rows if out is None else out.union(rows)
        if d == levels or "children" not in level.schema["node"].dataType.fieldNames():
            break
        level = level.select(key, "at", F.posexplode("node.children").alias("p", "node")).select(key, F.concat("at", F.array("p")).alias("at"), "node")
    return out.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy("at")))


def sentences(docs: DataFrame, key: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """``(key, n, start, sentence, window)``: sentences ending in a full stop, with offsets; the window adds the next one."""
    parts = docs.select(key, *(keep or []), F.posexplode(F.split(text, "(?<=。)")).alias("n", "sentence")).where("sentence <> ''")
    w = Window.partitionBy(key).orderBy("n")
    start = F.coalesce(F.sum(F.length("sentence")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("start", start).withColumn("window", F.concat("sentence", F.coalesce(F.lead("sentence").over(w), F.lit(""))))
