"""Terms of several dictionaries gathered into hubs, homographs kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.functions.text import bigrams, jaccard, preferred_key, reading_key


def term_hubs(terms: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``(term_id, hub_id, anchor_id, map_type, is_anchor, overlap)``, one row a term.

    ``terms``: term_id, scheme_id, authority_rank, term_tier, pref, reading, definition. Terms of rank 100
    to 102 and tier 1 with one head word and reading form a hub around a neutral anchor (rank 100 first,
    then the better definition, scheme, id). Another dictionary's term joins by its key alone; the same
    dictionary's needs an overlap of definitions, else it is a homograph with its own hub. Terms without a
    reading join a hub of their head word, special terms attach to a hub of their key, the rest stay alone.
    Other tiers of the base ranks are reported as left_out, not dropped.
    """
    t = terms.withColumn("p", preferred_key(F.col("pref"))).withColumn("r", F.coalesce(reading_key(F.col("reading")), F.lit("")))
    base = F.col("authority_rank").startswith("100") | F.col("authority_rank").isin("101", "102")
    quality = F.when(F.coalesce(F.trim("definition"), F.lit("")) == "", 2).when(F.length(F.trim("definition")) < 8, 1).otherwise(0)
    role = F.when(base & (F.coalesce("term_tier", F.lit("1")) != "1"), "left_out").when(~base, "special").when(F.col("r") == "", "no_reading").otherwise("seed")
    t = t.withColumn("role", role).withColumn("grams", bigrams(F.coalesce("definition", F.lit("")))).withColumn("order", F.struct((~F.col("authority_rank").startswith("100")).cast("int").alias("a"), quality.alias("q"), F.col("scheme_id").alias("s"), F.col("term_id").alias("t")))
    seeds = t.where("role = 'seed'").withColumn("anchor", F.first(F.struct("term_id", "scheme_id", "grams")).over(Window.partitionBy("p", "r").orderBy("order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    overlap = jaccard(F.col("grams"), F.col("anchor.grams"))
    is_anchor = F.col("term_id") == F.col("anchor.term_id")
    joins = is_anchor | (F.col("scheme_id") != F.col("anchor.scheme_id")) | (overlap >= threshold)
    seeded = seeds.select("term_id", "p", "r", F.when(joins, F.col("anchor.term_id")).otherwise(F.col("term_id")).alias("anchor_id"), F.when(joins, "merged").otherwise("homograph_split").alias("m"), F.round(overlap, 3).alias("overlap"), (is_anchor | ~joins).alias("is_anchor"))
    size = Window.partitionBy("anchor_id")
    seeded = seeded.withColumn("map_type", F.when(F.col("m") != "merged", F.col("m")).when(F.count(F.lit(1)).over(size) > 1, "skos_exact_match").otherwise("bedrock_seed"))
    heads = seeds.where(is_anchor).select("p", "r", F.col("term_id").alias("hub_anchor"), F.col("scheme_id").alias("hub_scheme"), F.col("grams").alias("hub_grams"))
    # without a reading: the hub of the same head word with the best overlap; within one dictionary it must reach the threshold
    bare = t.where("role = 'no_reading'").join(heads.drop("r"), "p", "left").withColumn("ov", jaccard(F.col("grams"), F.col("hub_grams")))
    best = bare.groupBy("term_id").agg(F.max(F.when(F.col("hub_anchor").isNotNull(), F.struct("ov", (F.col("hub_scheme") != F.col("scheme_id")).alias("cross"), "hub_anchor"))).alias("b"))
    taken = F.col("b").isNotNull() & (F.col("b.cross") | (F.col("b.ov") >= threshold))
    bare = best.select("term_id", F.when(taken, F.col("b.hub_anchor")).otherwise(F.col("term_id")).alias("anchor_id"), F.when(taken, "reading_missing_def_match").otherwise("reading_missing_seed").alias("map_type"), (~F.coalesce(taken, F.lit(False))).alias("is_anchor"), F.round("b.ov", 3).alias("overlap"))
    special = t.where("role = 'special'").join(heads, ["p", "r"], "left").select("term_id", F.coalesce("hub_anchor", "term_id").alias("anchor_id"), F.when(F.col("hub_anchor").isNotNull(), "skos_close_match").otherwise("specialty_seed").alias("map_type"), F.col("hub_anchor").isNull().alias("is_anchor"), F.lit(None).cast("double").alias("overlap"))
    left = t.where("role = 'left_out'").select("term_id", F.lit(None).cast("string").alias("anchor_id"), F.lit("left_out").alias("map_type"), F.lit(False).alias("is_anchor"), F.lit(None).cast("double").alias("overlap"))
    every = seeded.select("term_id", "anchor_id", "map_type", "is_anchor", "overlap").unionByName(bare).unionByName(special).unionByName(left)
    return every.withColumn("hub_id", F.when(F.col("anchor_id").isNotNull(), F.concat(F.lit("hub:"), F.substring(F.sha1("anchor_id"), 1, 12))))


def cross_scheme(hubs: DataFrame, terms: DataFrame) -> DataFrame:
    """Hubs that terms of two dictionaries or more share."""
    return hubs.join(terms.select("term_id", "scheme_id"), "term_id").where("hub_id is not null").groupBy("hub_id").agg(F.count_distinct("scheme_id").alias("n_schemes"), F.count(F.lit(1)).alias("n_terms")).where("n_schemes >= 2")
