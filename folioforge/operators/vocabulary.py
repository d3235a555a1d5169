"""Adapters of dictionaries before they become hubs, and reports on how they meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import preferred_key, reading_key


def first_filled(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """``(keys, value)``: the first non-empty value of each key in the given order, by one aggregation."""
    return df.where(F.coalesce(F.trim(value), F.lit("")) != "").groupBy(*keys).agg(F.min(F.struct(*order, value))[value].alias(value))


def attach_definitions(terms: DataFrame, labels: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Terms whose empty definitions are filled with the first definition label of their key; others stay.

    ``labels``: key, label_type, text and the order columns.
    """
    first = first_filled(labels.where("label_type = 'definition'").select(key, *order, F.col("text").alias("_text")), [key], "_text", order)
    return terms.join(first, key, "left").withColumn("definition", F.coalesce(F.nullif(F.trim("definition"), F.lit("")), "_text")).drop("_text")


def clean_terms(raw: DataFrame, pref: str, definition: str, readings: list[str], trash: str, order: list[str]) -> DataFrame:
    """Headwords without brackets and trash, each with its first filled reading, one row a headword and beginning of its definition.

    ``trash``: a pattern of headwords that are none; ``readings``: columns tried in order. The first row by ``order`` counts.
    """
    bare = F.trim(F.regexp_replace(pref, r"[\[［【〔(（][^\]］】〕)）]*[\]］】〕)）]", ""))
    filled = [F.nullif(F.trim(c), F.lit("")) for c in readings]
    rows = raw.select("*", bare.alias("_pref"), F.coalesce(*filled).alias("_reading"), F.substring(F.coalesce(definition, F.lit("")), 1, 80).alias("_begin"))
    rows = rows.where((F.length("_pref") > 0) & ~F.col("_pref").rlike(trash))
    return rows.groupBy(F.col("_pref").alias("pref"), "_begin").agg(F.min(F.struct(*order, "_reading", F.col(definition).alias("_def"))).alias("m")).select("pref", F.col("m._reading").alias("reading"), F.col("m._def").alias("definition"))


def backfill_readings(terms: DataFrame, readings: DataFrame, pref: str, reading: str) -> DataFrame:
    """Missing readings from another list's first reading of the same headword."""
    known = readings.select(preferred_key(F.col(pref)).alias("_k"), F.col(reading).alias("_r")).where("coalesce(_r, '') <> ''").groupBy("_k").agg(F.min("_r").alias("_r"))
    return terms.withColumn("_k", preferred_key(F.col(pref))).join(known, "_k", "left").withColumn(reading, F.coalesce(F.nullif(F.col(reading), F.lit("")), "_r")).drop("_k", "_r")


def match_rates(a: DataFrame, b: DataFrame, pref: str, reading: str, key: str | None = None) -> DataFrame:
    """One row: terms of ``a``, those with a partner by headword and reading, by headword alone, and those lost by the reading.

    ``key``: a column that holds the headword's key already.
    """
    of = F.col(key) if key else preferred_key(F.col(pref))
    keyed = lambda df: df.select(of.alias("p"), F.coalesce(reading_key(F.col(reading)), F.lit("")).alias("r"))
    x, y = keyed(a), keyed(b)
    full, head = y.distinct().withColumn("full", F.lit(True)), y.select("p").distinct().withColumn("head", F.lit(True))
    j = x.join(full, ["p", "r"], "left").join(head, "p", "left")
    return j.agg(F.count(F.lit(1)).alias("terms"), F.count("full").alias("full_key"), F.count("head").alias("head_only_bound"), F.count_if(F.col("head") & F.col("full").isNull()).alias("lost_by_reading"))


def empty_definition_trace(terms: DataFrame, hubs: DataFrame) -> DataFrame:
    """``(tier, landing, terms, partner_defined)``: where terms without a definition land: alone, as anchor of several, or absorbed, and whether a partner of the hub defines it.

    ``terms``: term_id, term_tier, definition; ``hubs``: term_id, hub_id, is_anchor.
    """
    defined = F.coalesce(F.trim("definition"), F.lit("")) != ""
    j = terms.select("term_id", F.col("term_tier").alias("tier"), defined.alias("defined")).join(hubs.select("term_id", "hub_id", "is_anchor"), "term_id")
    sizes = j.groupBy("hub_id").agg(F.count(F.lit(1)).alias("size"), F.bool_or("defined").alias("any_defined"))
    rows = j.where("not defined").join(sizes, "hub_id", "left")
    landing = F.when(F.col("hub_id").isNull(), "left_out").when(F.col("is_anchor") & (F.col("size") == 1), "anchor_single").when(F.col("is_anchor"), "anchor_multi").otherwise("absorbed")
    return rows.groupBy("tier", landing.alias("landing")).agg(F.count(F.lit(1)).alias("terms"), F.count_if("any_defined").alias("partner_defined"))


def homograph_pairs(hubs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(split_id, main_id, label)``: split terms with the main anchor of their headword and reading."""
    t = terms.select("term_id", preferred_key(F.col("pref")).alias("p"), F.coalesce(reading_key(F.col("reading")), F.lit("")).alias("r"))
    j = hubs.select("term_id", "map_type", "is_anchor").join(t, "term_id")
    main = j.where("is_anchor and map_type <> 'homograph_split'").groupBy("p", "r").agg(F.min("term_id").alias("main_id"))
    return j.where("map_type = 'homograph_split'").join(main, ["p", "r"]).select(F.col("term_id").alias("split_id"), "main_id", F.col("p").alias("label"))


def relabel(articles: DataFrame, folder: Column, cited: Column, catch_all: DataFrame, aliases: dict[str, str], merged: dict[str, str]) -> DataFrame:
    """Adds ``journal`` and ``journal_source``: the folder's journal, or in catch-all folders the one cited.

    ``catch_all``: one column ``folder``. ``aliases`` name folders, ``merged`` names of one journal.
    """
    of = lambda names, c: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), c), c) if names else c
    rows = articles.withColumn("_folder", of(aliases, folder)).withColumn("_cited", F.nullif(cited, F.lit("")))
    mixed = catch_all.select(F.col("folder").alias("_folder")).distinct().withColumn("_mixed", F.lit(True))
    j = rows.join(mixed, "_folder", "left")
    name = F.when(F.col("_mixed"), F.coalesce("_cited", "_folder")).otherwise(F.col("_folder"))
    source = F.when(F.col("_mixed") & F.col("_cited").isNotNull(), "cited_in_catch_all").when(F.col("_mixed"), "folder_fallback").otherwise("folder")
    return j.withColumn("journal", of(merged, name)).withColumn("journal_source", source).drop("_folder", "_cited", "_mixed")


def journal_status(folder: Column, named: Column) -> Column:
    """name_match, conflict or folder_only, by what folder and article say."""
    return F.when(F.coalesce(named, F.lit("")) == "", "folder_only").when(folder == named, "name_match").otherwise("conflict")


def author_links(articles: DataFrame, people: DataFrame) -> DataFrame:
    """``(author_id, person_id, basis, confidence, status)``: by number high and accepted, by name and affiliation medium, by name alone low; only numbers are accepted.

    ``articles``: author_id, name, nrid, affiliation; ``people``: person_id, name, nrid, affiliation. Of several people of one basis the least id is named.
    """
    out = articles.select("author_id", "name", "nrid", "affiliation")
    for basis, keys in (("nrid", ["nrid"]), ("name_affiliation", ["name", "affiliation"]), ("name", ["name"])):
        filled = " and ".join(f"coalesce({k}, '') <> ''" for k in keys)
        out = out.join(people.where(filled).groupBy(*keys).agg(F.min("person_id").alias(f"_{basis}")), keys, "left")
    basis = F.when(F.col("_nrid").isNotNull(), "nrid").when(F.col("_name_affiliation").isNotNull(), "name_affiliation").when(F.col("_name").isNotNull(), "name")
    level = F.when(basis == "nrid", "high").when(basis == "name_affiliation", "medium").when(basis == "name", "low")
    return out.select("author_id", F.coalesce("_nrid", "_name_affiliation", "_name").alias("person_id"), basis.alias("basis"), level.alias("confidence"), F.when(basis == "nrid", "accepted").when(basis.isNotNull(), "candidate").otherwise("unlinked").alias("status"))
