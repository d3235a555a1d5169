"""Repairs as plans: detectors that give ``(book, source, idx, field, before, after)`` rows, never writes.

Plug-ins register under a name with a class that says where a plan may be applied.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import toc_title_key

#: classes of repairs and the phases in which their plans may be applied
MAY_APPLY = {"derived": {"derive", "review"}, "mark": {"review"}, "canonical": set()}
# Headings that may stand alone in one source without being suspect.
FRONT_AND_BACK = r"(索引|別表|凡例|書式|資料編?|付録|附録|参考文献|奥付|目次|はしがき|序文|あとがき)"
PLAN = ["book_id", "source", "idx", "field", "before", "after"]


@dataclass(frozen=True)
class Repairer:
    name: str
    repair_class: str
    version: str
    plan: Callable[[DataFrame, DataFrame], DataFrame]


REGISTRY: dict[str, Repairer] = {}


def repairer(name: str, repair_class: str, version: str = "1"):
    """Registers ``plan(nodes, books)``; a second repairer of one name is an error."""

    def add(f):
        if name in REGISTRY:
            raise ValueError(f"repairer {name} exists")
        if repair_class not in MAY_APPLY:
            raise ValueError(f"unknown class {repair_class}")
        REGISTRY[name] = Repairer(name, repair_class, version, f)
        return f

    return add


def _rows(df: DataFrame, field: str, before, after) -> DataFrame:
    return df.select("book_id", "source", "idx", F.lit(field).alias("field"), before.cast("string").alias("before"), after.cast("string").alias("after"))


@repairer("offset_page", "derived")
def offset_page(nodes: DataFrame, books: DataFrame) -> DataFrame:
    """Print pages from raw pages, where the book's offset is certain: confidence 1, validated, two anchors or more."""
    sure = books.where("page_offset.confidence >= 1 and page_offset.validated and page_offset.anchors >= 2").select("book_id", F.col("page_offset.offset").alias("off"))
    return _rows(nodes.where("page is not null and print_page is null").join(sure, "book_id"), "print_page", F.col("print_page"), F.col("page") - F.col("off"))


@repairer("title_norm", "derived")
def title_norm(nodes: DataFrame, books: DataFrame) -> DataFrame:
    """Title keys that are missing or stale."""
    key = toc_title_key(F.col("title"))
    return _rows(nodes.where(F.col("title").isNotNull()).withColumn("_k", key).where(~F.col("_k").eqNullSafe(F.col("title_norm"))), "title_norm", F.col("title_norm"), F.col("_k"))


@repairer("body_sha", "derived")
def body_sha(nodes: DataFrame, books: DataFrame) -> DataFrame:
    """Missing digests of sources whose content is at hand, one row a source at idx -1."""
    b = books.where("source_content is not null and coalesce(source_sha256, '') = ''").withColumn("idx", F.lit(-1))
    return _rows(b, "source_sha256", F.col("source_sha256"), F.sha2(F.col("source_content"), 256))


@repairer("orphan_quarantine", "mark")
def orphan_quarantine(nodes: DataFrame, books: DataFrame) -> DataFrame:
    """Marks headings that one source alone has, in books of two sources or more; front and back matter and sparse sources are left."""
    keyed = nodes.withColumn("_k", toc_title_key(F.col("title"))).where("coalesce(_k, '') <> ''")
    many = keyed.groupBy("book_id").agg(F.count_distinct("source").alias("n")).where("n >= 2").select("book_id")
    lone = keyed.groupBy("book_id", "_k").agg(F.count_distinct("source").alias("n")).where("n = 1").select("book_id", "_k")
    sparse = books.where("coalesce(sparse, false) or coalesce(multi_volume, false)").select("book_id", "source").distinct()
    rows = keyed.join(many, "book_id", "left_semi").join(lone, ["book_id", "_k"], "left_semi").join(sparse, ["book_id", "source"], "left_anti")
    return _rows(rows.where("quarantine_reason is null").where(~F.col("title").rlike(FRONT_AND_BACK)), "quarantine_reason", F.col("quarantine_reason"), F.lit("orphan"))


def plan_all(nodes: DataFrame, books: DataFrame, phase: str) -> DataFrame:
    """Every plan as one table, with the repairer and whether the phase may apply it."""
    out = None
    for r in REGISTRY.values():
        rows = r.plan(nodes, books).withColumn("repairer", F.lit(f"{r.name}@{r.version}")).withColumn("may_apply", F.lit(phase in MAY_APPLY[r.repair_class]))
        out = rows if out is None else out.unionByName(rows)
    return out
