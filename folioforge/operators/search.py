"""Ranked outline search and the links a hit leads to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.functions.text import HIRAGANA, KATAKANA, loose_key, search_key


def search_index(nodes: DataFrame, title: str, path: str, wide: bool = True) -> DataFrame:
    """Adds the four precomputed keys; materialise once, search often."""
    keyed = nodes.withColumn("title_key", search_key(F.col(title), wide)).withColumn("path_key", search_key(F.coalesce(path, F.lit("")), wide))
    return keyed.withColumn("title_loose", loose_key(F.col("title_key"))).withColumn("path_loose", loose_key(F.col("path_key")))


def search(index: DataFrame, query: str, *, page: str, depth: str, tiebreak: list[str], limit: int = 30) -> DataFrame:
    """The best ``limit`` nodes for a query; a blank query finds nothing.

    Title equal 100, begins 80, holds 60, holds without blanks 50, path holds 40,
    without blanks 30; a page adds 5 and a shallow node up to 3 more.
    """
    q = query.lower().translate(dict(zip(map(ord, KATAKANA), HIRAGANA))).strip()
    loose = "".join(q.split())
    t, p = F.col("title_key"), F.col("path_key")
    base = (
        F.when(t == q, 100).when(t.startswith(q), 80).when(t.contains(q), 60).when(F.col("title_loose").contains(loose), 50).when(p.contains(q), 40).when(F.col("path_loose").contains(loose), 30)
    )
    score = base + F.when(F.col(page).isNotNull(), 5).otherwise(0) + F.greatest(F.lit(0), 4 - F.coalesce(F.nullif(F.col(depth), F.lit(0)), F.lit(1)))
    hits = index.withColumn("score", score).where(F.col("score").isNotNull() & F.lit(bool(loose)))
    return hits.orderBy(F.desc("score"), F.coalesce(F.col(page), F.lit(1_000_000_000)), *tiebreak).limit(limit)


def outline_lines(nodes: DataFrame, *, keep: list[str], title: str, depth: str) -> DataFrame:
    """Nested list lines with the columns that place them; titles of under two characters are left out.

    A line is a row: a copy of one outline sorts its own lines, and none is gathered here.
    """
    line = F.concat(F.repeat(F.lit("  "), F.greatest(F.coalesce(depth, F.lit(1)), F.lit(1)) - 1), F.lit("- "), F.col(title))
    return nodes.where(F.length(title) >= 2).select(*keep, line.alias("line"))


def resolve_links(nodes: DataFrame, sources: DataFrame, links: DataFrame) -> DataFrame:
    """Every node against every source (a short list): page, book top, shelf or nothing.

    ``sources``: source_id, page_url; ``links``: book_id, source_id, book_key, offset, location.
    """
    each = nodes.crossJoin(F.broadcast(sources)).join(links, ["book_id", "source_id"], "left")
    paged = F.col("book_key").isNotNull() & F.col("page_url").isNotNull()
    kind = (
        F.when(paged & F.col("offset").isNotNull() & F.col("page").isNotNull(), "page").when(paged, "book_top").when(F.col("location").isNotNull(), "physical").otherwise("unavailable")
    )
    url = F.when(kind == "page", F.replace(F.replace("page_url", F.lit("{key}"), F.col("book_key")), F.lit("{page}"), (F.col("page") + F.col("offset")).cast("string")))
    return each.withColumn("kind", kind).withColumn("url", url).withColumn("reason", F.when((kind == "book_top") & F.col("offset").isNull(), "offset_not_calibrated"))


def mode_of(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The commonest value of each group (least of equals), its count and share."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy(*group).agg(F.max(F.struct("n", (-F.col(value)).alias("v"))).alias("m"), F.sum("n").alias("total"))
    return top.select(*group, (-F.col("m.v")).alias("mode"), F.col("m.n").alias("n"), (F.col("m.n") / F.col("total")).alias("share"))


def cosine_topk(vectors: DataFrame, key: str, vector: str, query: list[float], k: int) -> DataFrame:
    """Exact nearest vectors by cosine."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    v = F.col(vector)
    return vectors.select(key, (dot(v, q) / F.sqrt(dot(v, F.transform(v, lambda x: x.cast("double"))) * dot(q, q))).alias("cosine")).orderBy(F.desc("cosine"), key).limit(k)


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
