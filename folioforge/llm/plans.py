"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.canonical import entry_of_records, map_to_list
from folioforge.llm.codepoints import lookalike_pairs
from folioforge.llm.encoding import encode_corpus
from folioforge.llm.leakage import leaked_passages
from folioforge.llm.matching import match_records
from folioforge.llm.names import client_links, same_client_pairs
from folioforge.llm.residue import residue_documents
from folioforge.operators.snapshots import record_key
from folioforge.runtime import checked_broadcast, table


def _publishers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    held = table(spark, d, "holdings").select(F.lit("holdings").alias("record_table"), record_key(F.col("internal_id")).alias("record_id"), F.col("publisher").alias("value"))
    wanted = table(spark, d, "candidates").select(F.lit("candidates").alias("record_table"), F.col("id").alias("record_id"), F.col("publisher").alias("value"))
    rows = held.union(wanted).where(r"record_id is not null and value rlike '[^\\s\\p{Z}]'")
    entries = table(spark, d, "publisher_master").select(F.col("publisher_id").alias("entry"), F.col("publisher_name").alias("name"), "reading")
    return rows, entries


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The publisher of each record that has one typed freely; 0 where the list has none."""
    rows, entries = _publishers(spark, d)
    mapped = map_to_list(rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")), entries)
    names = checked_broadcast(entries.select(F.col("name").alias("value"), F.lit(True).alias("literal")).distinct())
    free = rows.select("record_table", "record_id", "value").join(names, "value", "left").groupBy("record_table", "record_id").agg(F.bool_or(F.col("literal").isNull()).alias("free")).where("free")
    found = entry_of_records(rows, mapped, ["record_table", "record_id"])
    return found.join(free, ["record_table", "record_id"], "left_semi").withColumnRenamed("entry", "publisher_id")


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """Every typed publisher with its entry and distance; nulls are the misses."""
    rows, entries = _publishers(spark, d)
    return map_to_list(rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")), entries)


def _bibliographies(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    def cols(name: str, key: str, title: str) -> DataFrame:
        return table(spark, d, name).select(F.col(key).alias("id"), F.col(title).alias("title"), "publisher", "author", "year", "edition", "volume", F.col("page_count").alias("pages"), F.col("ingested_at").alias("at"))

    return cols("legallib_bib", "legallib_book_id", "legallib_title"), cols("canonical_bib", "canonical_bib_id", "canonical_title")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of records that describe the same manifestation."""
    held = match_records(*_bibliographies(spark, d)).where("probability >= 0.5")
    return held.select(F.col("left_id").alias("legallib_book_id"), F.col("right_id").alias("canonical_bib_id"))


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """The links with titles, gap of years and confidence."""
    left, right = _bibliographies(spark, d)
    year = lambda c: F.regexp_extract(c, "(1[89]|20)[0-9]{2}", 0).try_cast("int")
    one = lambda df, side: df.groupBy("id").agg(F.max(F.struct("at", "title", "year")).alias("m")).select(F.col("id").alias(f"{side}_id"), F.col("m.title").alias(f"{side}_title"), year(F.col("m.year")).alias(f"{side}_year"))
    held = match_records(left, right).where("probability >= 0.5")
    return held.join(one(left, "left"), "left_id").join(one(right, "right"), "right_id").select(
        F.col("left_id").alias("legallib_book_id"), F.col("right_id").alias("canonical_bib_id"), F.col("left_title").alias("legallib_title"), F.col("right_title").alias("canonical_title"),
        F.abs(F.col("left_year") - F.col("right_year")).alias("year_gap"), F.round("probability", 4).alias("resolver_confidence"),
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Titles that look the same but differ in characters."""
    part = lambda name, scope, key, text: table(spark, d, name).select(F.lit(name).alias("record_table"), scope.alias("scope"), key.alias("key"), F.col(text).alias("raw"))
    rows = (
        part("books", F.lit(""), F.col("book_id"), "title")
        .union(part("holdings", F.lit(""), record_key(F.col("internal_id")), "title_norm"))
        .union(part("toc_nodes", F.col("book_id"), F.col("toc_node_id"), "title"))
    )
    return lookalike_pairs(rows, scope=["record_table", "scope"], key="key", text="raw").drop("scope")


def _client_rows(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "dict_aliases").select(F.col("alias_key").alias("row"), F.col("canonical_client").alias("name"), F.col("alias_term").alias("alias"), "kind")
    b = table(spark, d, "dict_attorney_prior").select(F.col("prior_key").alias("row"), F.col("依頼者").alias("name"), F.lit(None).cast("string").alias("alias"), F.lit(None).cast("string").alias("kind"))
    return a.union(b)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows that name one client."""
    return same_client_pairs(client_links(_client_rows(spark, d)))


def p6_clients(spark: SparkSession, d: str) -> DataFrame:
    """The client that each row stands for."""
    return client_links(_client_rows(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(table(spark, d, "documents"), key="doc_id", text="text").withColumnRenamed("key", "doc_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that give away a stretch of a held-out question, with the item."""
    found = leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_item"), key="doc_id", text="text", item="item_id", passage="question")
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents of template residue, filler, error pages or notices."""
    return residue_documents(table(spark, d, "documents"), key="doc_id", text="text", group="doc_kind").select(F.col("key").alias("doc_id"))


QUERIES = {f.__name__: f for f in (p1_found, p1_values, p2_found, p2_links, p3_found, p6_found, p6_clients, p7_ids, p8_found, p9_found)}
ORACLES: dict[str, str] = {}
