"""Readers and sinks for line records, tables, statutes, front matter and file fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema, required: str | None = None) -> DataFrame:
    """One record a line, split at \\n only; comment records are skipped, a missing required key fails.

    Unicode line separators inside a record do not split it.
    """
    kept = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value")).where(F.trim("value") != "")
    kept = kept.where(F.get_json_object("value", "$._comment").isNull())
    rows = kept.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    if required:
        rows = rows.withColumn(required, F.coalesce(required, F.raise_error(F.lit(f"a record has no {required}"))))
    return rows


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header, in UTF-8 with or without a byte-order mark."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_json_dir(spark: SparkSession, path: str, schema, reserved: tuple[str, ...] = ()) -> DataFrame:
    """Every JSON file of a folder with its stem and a state: ok or unreadable; reserved names are left out."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")
    raw = raw.where(F.col("file").endswith(".json") & ~F.col("file").isin(*reserved) if reserved else F.col("file").endswith(".json"))
    ok = F.try_parse_json("value").isNotNull()
    return raw.select(F.regexp_replace("file", r"\.json$", "").alias("stem"), F.when(ok, "ok").otherwise("unreadable").alias("state"), F.from_json("value", schema).alias("record"))


def file_states(keys: DataFrame, key: str, files: DataFrame) -> DataFrame:
    """absent, ok or unreadable for each key."""
    return keys.join(files.select(F.col("stem").alias(key), "state"), key, "left").withColumn("state", F.coalesce("state", F.lit("absent")))


def locate_nodes(record, names: tuple[str, ...] = ("toc", "nodes", "toc_nodes", "items")):
    """The node list of a variant: the value itself if it is a list, else the first named one that is."""
    is_list = lambda v: F.schema_of_variant(v).startswith("ARRAY")
    out = F.when(is_list(record), record)
    for n in names:
        v = F.try_variant_get(record, f"$.{n}", "variant")
        out = out.when(v.isNotNull() & is_list(v), v)
    return out


def read_statute_xml(spark: SparkSession, path: str) -> DataFrame:
    """``(file, order_index, article_number, caption, text, deleted)`` of the articles of statutes' main parts.

    The text is that of sentences, paragraph numbers and item titles in the order of the document. A file that is
    no XML gives no rows; one without a main part is read whole. A file is parsed in one task, and a statute is small.
    """
    from collections.abc import Iterator
    from xml.etree import ElementTree

    import pandas as pd

    told = {"Sentence", "ParagraphNum", "ItemTitle"}
    columns = ["file", "order_index", "article_number", "caption", "text", "deleted"]

    def articles(name: str, content: bytes) -> Iterator[tuple]:
        try:
            root = ElementTree.fromstring(content)
        except ElementTree.ParseError:
            return
        main = next(root.iter("MainProvision"), root)
        for n, article in enumerate(main.iter("Article")):
            caption = article.find("ArticleCaption")
            parts = ["".join(x.itertext()).strip() for x in article.iter() if x.tag in told]
            yield name, n, (article.get("Num") or "").replace("_", "-") or None, "".join(caption.itertext()) if caption is not None else None, "".join(parts), article.get("Delete") == "true"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([row for name, content in pdf.itertuples(index=False) for row in articles(name, content)], columns=columns)

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.mapInPandas(run, "file string, order_index int, article_number string, caption string, text string, deleted boolean")


def read_front_matter(spark: SparkSession, path: str) -> DataFrame:
    """``(file, meta, body, label)`` of marked-up texts: the leading block as a map, the first line that says something."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r\n", "\n").alias("value"))
    block = F.regexp_extract("value", r"^---\n([\s\S]*?)\n---(?:\n|$)", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^\s*[\w\-]+\s*:"))
    pair = lambda x: F.struct(F.trim(F.regexp_extract(x, r"^\s*([\w\-]+)\s*:", 1)), F.trim(F.regexp_replace(F.regexp_extract(x, r"^\s*[\w\-]+\s*:(.*)$", 1), r"\s+#.*$|^\s*#.*$", "")))
    body = F.regexp_replace("value", r"^---\n[\s\S]*?\n---(?:\n|$)", "")
    return raw.select("file", F.map_from_entries(F.transform(lines, pair)).alias("meta"), body.alias("body"), F.trim(F.regexp_extract(body, r"^\s*(\S[^\n]*)", 1)).alias("label"))


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """sha256 of each file, and one over the sorted ``name:sha`` lines of all."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha"))
    whole = files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "name", "sha"))), "\n"), 256).alias("fingerprint"))
    return files.crossJoin(F.broadcast(whole))


def write_staged(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Written beside the target and renamed, so a reader never sees half a table; an old one is kept as ``.bak``."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    of = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    df.write.mode("overwrite").format(fmt).save(path + ".staged")
    fs = of(path).getFileSystem(conf)
    if fs.exists(of(path)):
        fs.delete(of(path + ".bak"), True)
        fs.rename(of(path), of(path + ".bak"))
    fs.rename(of(path + ".staged"), of(path))


def remap(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames actual to expected columns where the expected one is missing."""
    for want, has in names.items():
        if want not in df.columns and has in df.columns:
            df = df.withColumnRenamed(has, want)
    return df


def synthetic_outlines(spark: SparkSession, books: int = 5206, seed: int = 7) -> DataFrame:
    """Three-level outlines made by hashing, the same on every run and any partitioning."""
    n = lambda salt, k: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id", *k), F.lit(100))
    b = spark.range(books)
    chapters = b.select("id", F.explode(F.sequence(F.lit(1), (n("c", []) % 8 + 4).cast("int"))).alias("c"))
    sections = chapters.select("id", "c", F.explode(F.sequence(F.lit(0), (n("s", ["c"]) % 6 + 2).cast("int"))).alias("s"))
    items = sections.select("id", "c", "s", F.explode(F.sequence(F.lit(0), F.when(F.col("s") == 0, 0).otherwise((n("i", ["c", "s"]) % 5).cast("int")))).alias("i"))
    depth = F.when(F.col("s") == 0, 1).when(F.col("i") == 0, 2).otherwise(3)
    title = F.when(depth == 1, F.format_string("第%d章", F.col("c"))).when(depth == 2, F.format_string("第%d節", F.col("s"))).otherwise(F.format_string("%d 項", F.col("i")))
    return items.select(F.format_string("book%06d", F.col("id")).alias("book_id"), F.concat_ws(".", "c", "s", "i").alias("path_no"), depth.alias("depth"), title.alias("title"))


def read_rows(spark: SparkSession, url: str, query: str, allowed: set[str], **options: str) -> DataFrame:
    """Rows of a database through a read-only SELECT over listed tables; anything else is refused before a connection is made."""
    import re

    text = query.strip()
    if not re.match(r"(?is)^select\b", text) or ";" in text or re.search(r"(?i)\b(insert|update|delete|merge|drop|alter|create|truncate|grant|call)\b", text):
        raise ValueError("only a single SELECT is read")
    named = {t.lower() for t in re.findall(r"(?i)\b(?:from|join)\s+([\w.]+)", text)}
    if not named or named - {a.lower() for a in allowed}:
        raise ValueError(f"tables not listed: {sorted(named - {a.lower() for a in allowed})}")
    return spark.read.format("jdbc").option("url", url).option("query", text).options(**options).load()


def write_bundle(path: str, *, lines: dict[str, DataFrame] | None = None, tables: dict[str, DataFrame] | None = None, texts: dict[str, DataFrame] | None = None) -> list[str]:
    """The artefacts of a run under one folder: records as JSON lines, tables as CSV with a header, texts (column ``text``) as Markdown or HTML files.

    Each is a folder of part files that executors write side by side; nothing passes the driver.
    """
    made = []
    for name, df in (lines or {}).items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}.jsonl")
        made.append(f"{path}/{name}.jsonl")
    for name, df in (tables or {}).items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/{name}.csv")
        made.append(f"{path}/{name}.csv")
    for name, df in (texts or {}).items():
        df.select("text").write.mode("overwrite").text(f"{path}/{name}")
        made.append(f"{path}/{name}")
    return made
