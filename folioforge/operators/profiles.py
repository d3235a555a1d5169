"""Demand distributions, candidate profiles, health scores and catch-all folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.runtime import checked_broadcast


# The domain of each genre of the house.
GENRE_TO_DOMAIN = {
    "M&A": "commercial", "事業承継": "commercial", "経済法": "commercial", "商法・会社法": "commercial", "コーポレート": "commercial", "ファイナンス": "commercial", "ベンチャー・IPO": "commercial", "コンプライアンス": "commercial", "渉外法務": "commercial", "企業法務": "commercial", "登記実務": "commercial", "経済・経営": "commercial", "経営": "commercial", "経営管理": "commercial", "会計・財務": "commercial",
    "民事実務": "civil", "民法": "civil", "家族法・相続": "civil", "家事実務": "civil", "不動産": "civil", "不動産法": "civil", "交通事故": "civil", "消費者法": "civil", "倒産法": "civil",
    "訴訟実務": "procedure", "訴訟法": "procedure", "民事訴訟法": "procedure",
    "刑事実務": "criminal", "刑法": "criminal", "刑事訴訟法": "criminal",
    "公法実務": "administrative", "憲法": "administrative", "行政法": "administrative", "社会保障": "administrative", "環境法": "administrative",
    "労働法務": "labor", "労働法": "labor",
    "知的財産": "ip",
    "税務・会計": "tax", "税法": "tax",
    "情報法": "information", "国際法務": "international", "国際法": "international", "医事・薬事": "medical", "医事法": "medical", "法学一般": "other", "法制史": "other", "産業一般": "other", "その他": "other",
}
# The domain of class numbers that begin so; the longest that fits counts.
NDC_PREFIX_TO_DOMAIN = [
    ("320", "other"), ("321", "other"), ("322", "other"), ("323", "administrative"), ("324.6", "civil"), ("324.8", "civil"), ("324", "civil"), ("325", "commercial"), ("326", "criminal"), ("327.4", "civil"), ("327.6", "criminal"), ("327.2", "procedure"), ("327.3", "procedure"), ("327.5", "procedure"), ("327", "procedure"), ("328", "administrative"), ("329", "international"), ("330", "commercial"), ("335", "commercial"), ("336", "commercial"), ("338", "commercial"), ("345", "tax"), ("364", "administrative"), ("366", "labor"), ("498", "medical"), ("507.2", "ip"), ("519", "administrative"), ("007", "information"), ("673", "civil"),
]


def fractional_share(df: DataFrame, key: str, labels: str) -> DataFrame:
    """Each row spreads a weight of one over its distinct labels; shares over all labels."""
    each = df.withColumn("_l", F.array_distinct(F.array_compact(F.col(labels)))).where(F.size("_l") > 0).select(F.explode("_l").alias("label"), (F.lit(1.0) / F.size("_l")).alias("w"))
    sums = each.groupBy("label").agg(F.sum("w").alias("weight"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("weight").alias("total")))).select("label", "weight", (F.col("weight") / F.col("total")).alias("share"))


def candidate_profiles(candidates: DataFrame, tag_domain: DataFrame, *, key: str, out_of_domain: list[str], high_matched: int = 5, high_coverage: float = 0.05) -> DataFrame:
    """``(key, domain, weight)`` summing to one for each candidate that says anything.

    The primary domain weighs 2, each domain hit its count, each mapped tag 1.
    """
    primary = candidates.select(key, F.col("primary_domain").alias("domain"), F.lit(2.0).alias("w"))
    hits = candidates.select(key, F.explode("domain_hits").alias("domain", "w"))
    tags = candidates.select(key, F.explode("tags").alias("tag")).join(checked_broadcast(tag_domain), "tag").select(key, "domain", F.lit(1.0).alias("w"))
    both = primary.union(hits).union(tags).where(F.col("domain").isNotNull() & (F.col("domain") != "") & ~F.col("domain").isin(out_of_domain))
    sums = both.groupBy(key, "domain").agg(F.sum("w").alias("w"))
    total = Window.partitionBy(key)
    return sums.withColumn("t", F.sum("w").over(total)).where("t > 0").select(key, "domain", (F.col("w") / F.col("t")).alias("weight"))


def profile_source(toc_signal: Column, tag_signal: Column, matched: Column, coverage: Column, high_matched: int = 5, high_coverage: float = 0.05) -> tuple[Column, Column]:
    """``(source, confidence)`` of a profile."""
    source = F.when(toc_signal & tag_signal, "mixed").when(toc_signal, "toc_term_dict").when(tag_signal, "tag_domain_fallback").otherwise("unclassified")
    high = toc_signal & (F.coalesce(matched, F.lit(0)) >= high_matched) & (F.coalesce(coverage, F.lit(0.0)) >= high_coverage)
    return source, F.when(high, "high").when(toc_signal, "medium").otherwise("low")


def relevance(profiles: DataFrame, share: DataFrame, key: str, power: float = 1.0) -> DataFrame:
    """Sum over domains of share to the power, times the profile's weight."""
    s = checked_broadcast(share.select(F.col("label").alias("domain"), "share"))
    return profiles.join(s, "domain", "left").groupBy(key).agg(F.sum(F.pow(F.coalesce("share", F.lit(0.0)), F.lit(power)) * F.col("weight")).alias("relevance"))


def flagship_weight(nodes: Column, keyword: Column, alpha: float = 0.25) -> Column:
    """1 + alpha log(1 + nodes), a quarter more for a keyword or 200 nodes."""
    n = F.greatest(F.coalesce(nodes, F.lit(0)), F.lit(0))
    base = 1 + alpha * F.log1p(n)
    return F.when(F.coalesce(keyword, F.lit(False)) | (n >= 200), base * 1.25).otherwise(base)


def ranked(df: DataFrame, raw: str, tiebreak: list[str], n: int) -> DataFrame:
    """The best ``n`` by the raw score, with ranks and scores of 100 for the first."""
    top = df.orderBy(F.desc(raw), *tiebreak).limit(n)
    w = Window.orderBy(F.desc(raw), *tiebreak)  # n rows
    return top.withColumn("rank", F.row_number().over(w)).withColumn("score", F.round(100 * F.col(raw) / F.max(raw).over(Window.partitionBy()), 2))


def longest_prefix(df: DataFrame, code: str, prefixes: list[tuple[str, str]], value: str) -> DataFrame:
    """Adds the value of each code's longest known prefix; the list is short, so it is a map in the plan and no join."""
    known = F.create_map(*[F.lit(x) for pair in prefixes for x in pair])
    lengths = sorted({len(p) for p, _ in prefixes}, reverse=True)
    return df.withColumn(value, F.coalesce(*[F.when(F.length(code) >= k, F.try_element_at(known, F.substring(code, 1, k))) for k in lengths]))


def catch_all(df: DataFrame, folder: str, label: str, *, least: int = 300, dominant: float = 0.5, parts: int = 4, part_least: int = 20) -> DataFrame:
    """Folders of many kinds: large, no label in the majority, at least ``parts`` labels of some size."""
    counts = df.where(F.col(folder).isNotNull()).groupBy(folder, label).agg(F.count(F.lit(1)).alias("n"))
    g = counts.groupBy(folder).agg(F.sum("n").alias("size"), F.max(F.when(F.col(label).isNotNull(), F.col("n"))).alias("most"), F.count_if((F.col("n") >= part_least) & F.col(label).isNotNull()).alias("parts"))
    return g.where((F.col("size") >= least) & (F.col("most") / F.col("size") < dominant) & (F.col("parts") >= parts)).select(folder, "size", "most", "parts")


def health_score(l1: Column, l2: Column, l3: Column, chain_ok: Column, unresolved: Column) -> Column:
    """0 to 100: 30, 40 and 30 for the three layers; 0.85 of it while rows are unaccounted or conflicts open."""
    raw = 30 * l1 + 40 * l2 + 30 * l3
    return F.round(raw * F.when(chain_ok & (unresolved == 0), 1.0).otherwise(0.85), 1)


def fill_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(field, filled, total, percent)`` from one pass; blank texts are not filled."""
    filled = lambda c: F.count_if(F.coalesce(F.col(c).cast("string").rlike(r"[^\s\p{Z}]"), F.lit(False)))
    wide = df.agg(F.count(F.lit(1)).alias("total"), *[filled(c).alias(c) for c in cols])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in cols]))
    return wide.select("total", rows.alias("r")).select("r.field", "r.filled", "total", F.round(100.0 * F.col("r.filled") / F.nullif(F.col("total"), F.lit(0)), 1).alias("percent"))
