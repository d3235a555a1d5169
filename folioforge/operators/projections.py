"""Records brought to common columns, and selections and reports over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The names under which nodes carry their title, level and page, in the order in which they are tried.
TITLE_ALIASES = ["t", "title", "label", "name", "text"]
LEVEL_ALIASES = ["level", "l", "depth"]
PAGE_ALIASES = ["page_start", "print_page", "pdf_page", "page", "p"]


def first_of(df: DataFrame, names: list[str]) -> Column:
    """The first of the named columns that says something; columns that the table lacks are passed over."""
    there = [F.nullif(F.trim(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def page_of(col: Column) -> Column:
    """A page as a number above 0; anything else is null."""
    n = col.cast("string").try_cast("int")
    return F.when(n > 0, n)


def level_of(col: Column) -> Column:
    """A level of 1 or more; what is none is 1."""
    return F.greatest(F.coalesce(col.cast("string").try_cast("int"), F.lit(1)), F.lit(1))


def canonical_nodes(df: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes under any of their names as ``title, level, page``; rows without a title are dropped."""
    out = df.select(*keep, first_of(df, TITLE_ALIASES).alias("title"), level_of(first_of(df, LEVEL_ALIASES)).alias("level"), page_of(first_of(df, PAGE_ALIASES)).alias("page"))
    return out.where("title is not null")


def merge_shapes(nested: DataFrame, flat: DataFrame) -> DataFrame:
    """Two delivered shapes as rows ``isbn, source, idx, title``: a map of sources to titles, and rows of one source with its titles."""
    a = nested.select("isbn", F.explode("sources").alias("source", "titles")).select("isbn", "source", F.posexplode("titles").alias("idx", "title"))
    b = flat.select("isbn", "source", F.posexplode("nodes").alias("idx", "title"))
    return a.unionByName(b, allowMissingColumns=True)


def resolver_rows(df: DataFrame, key: str, isbn: str, bucket: str, order: str) -> DataFrame:
    """Usable decisions, the last of each key: accepted or for review, with an isbn."""
    good = df.where(F.col(bucket).isin("auto_accept", "human_review") & (F.coalesce(isbn, F.lit("")) != ""))
    return good.groupBy(key).agg(F.max_by(F.struct(isbn, bucket), order).alias("m")).select(key, f"m.{isbn}", f"m.{bucket}")


def open_without(df: DataFrame, missing: str, closed: str) -> DataFrame:
    """Rows that lack a field and are not closed."""
    return df.where(F.col(missing).isNull() & F.col(closed).isNull())


def active_without_deadline(df: DataFrame, status: str, active: list[str], raw: str, flag: str, reference: str) -> DataFrame:
    """Active rows whose raw record neither sets the flag nor names a reference."""
    no = ~F.coalesce(F.get_json_object(raw, flag).try_cast("boolean"), F.lit(False))
    return df.where(F.col(status).isin(active) & no & F.get_json_object(raw, reference).isNull())


def without_noise(df: DataFrame, text: str, patterns: list[str]) -> DataFrame:
    """Rows whose text shows none of the patterns; null texts stay."""
    return df.where(~F.coalesce(F.col(text).rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))) if patterns else df


def typed_case(df: DataFrame, fields: dict[str, tuple[list[str], str]]) -> DataFrame:
    """Typed columns from alternative raw ones: empty text is null, the first filled one counts, what cannot be cast is null."""
    return df.select(*[F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in names]).try_cast(kind).alias(out) for out, (names, kind) in fields.items()])


def pair_count(members: DataFrame, group: str, member: str) -> DataFrame:
    """How many pairs each group's distinct members would make: n (n - 1) / 2."""
    return members.groupBy(group).agg(F.count_distinct(member).alias("n")).select(group, "n", (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"))


def directory_profile(nodes: DataFrame, keys: list[str], title: str, level: str, page: str) -> DataFrame:
    """``(measure, value, n)``: how often each key is filled, levels, empty titles, pages."""
    filled = nodes.select(F.explode(F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in keys]))).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.lit("key").alias("measure"), "value", "n")
    levels = nodes.groupBy(F.coalesce(F.col(level).cast("string"), F.lit("none")).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("level").alias("measure"), "value", "n")
    sums = nodes.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.trim(title), F.lit("")) == "").alias("empty_title"), F.count(page).alias("with_page"))
    total = sums.select(F.explode(F.create_map(*[x for c in ("rows", "empty_title", "with_page") for x in (F.lit(c), F.col(c))])).alias("value", "n")).select(F.lit("total").alias("measure"), "value", "n")
    return reduce(DataFrame.unionByName, [filled, levels, total])


def real_suspect(year_gap: Column, version_a: Column, version_b: Column) -> Column:
    """Whether a suspected pair is one: a gap of a year and equal edition numbers are noise."""
    noise = F.coalesce(F.abs(year_gap) <= 1, F.lit(False)) | F.coalesce((version_a == version_b) & version_a.isNotNull(), F.lit(False))
    return ~noise


def diff_class(added: Column, removed: Column) -> Column:
    """enrich where nothing goes, replace where something does."""
    return F.when(removed > 0, "replace").otherwise("enrich")


def title_changes(old: DataFrame, new: DataFrame, keys: list[str], title: str) -> DataFrame:
    """``(keys, title, change)``: titles that only one side has, by an outer join of distinct rows, so no list is built."""
    a, b = old.select(*keys, title).distinct().withColumn("_a", F.lit(True)), new.select(*keys, title).distinct().withColumn("_b", F.lit(True))
    return a.join(b, [*keys, title], "full_outer").where("_a is null or _b is null").select(*keys, title, F.when(F.col("_a").isNull(), "added").otherwise("removed").alias("change"))


# What mends each defect.
ROUTES = {"page_offset_missing": "offset_page", "body_sha_missing": "body_sha", "title_norm_stale": "title_norm", "orphan_node": "orphan_quarantine"}


def repair_route(defect: Column) -> Column:
    """The repairer of a defect; what none mends goes to people."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair]), defect), F.lit("human_review"))


def by_priority(df: DataFrame, kind: str, order: list[str], size: str) -> DataFrame:
    """Rows by the place of their kind in a list, then the larger first."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in order]), F.col(kind)), F.lit(0))
    return df.orderBy(F.when(place == 0, len(order) + 1).otherwise(place), F.desc(size))


def next_task(tasks: DataFrame, lane: str, priority: str, rank: list[str], name: str) -> DataFrame:
    """The task to take: none while one is being done, else the first of the inbox by priority and name."""
    busy = tasks.where(F.col(lane) == "doing").limit(1).select(F.lit(True).alias("_busy"))
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k in rank]), F.col(priority)), F.lit(0)), F.lit(len(rank) + 1))
    first = tasks.where(F.col(lane) == "inbox").withColumn("_p", place).orderBy("_p", name).limit(1)
    return first.join(busy, F.lit(True), "left_anti").drop("_p")


def pooled_selection(pools: DataFrame, pool: str, order: list[str], key: str, names: list[str], each: int, most: int) -> DataFrame:
    """Up to ``each`` rows of every pool, a key once (in the pool named first), ``most`` at last: a report's selection."""
    place = F.array_position(F.array(*[F.lit(p) for p in names]), F.col(pool))
    ranked = pools.withColumn("_p", place).where("_p > 0")
    once = ranked.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy("_p", *order))).where("_k = 1")
    few = once.withColumn("_n", F.row_number().over(Window.partitionBy(pool).orderBy(*order, key))).where(F.col("_n") <= each)
    return few.orderBy("_n", "_p", *order, key).limit(most).drop("_p", "_k", "_n")


def top_labels(weights: DataFrame, key: str, label: str, weight: str, n: int = 3) -> DataFrame:
    """``(key, labels)``: the ``n`` heaviest labels of each key, best first."""
    rows = weights.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(weight), label))).where(F.col("_n") <= n)
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", label))), lambda x: x[label]).alias("labels"))


def compare_by_key(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, state)`` over the keys of either: only_a, only_b, differs or same."""
    j = a.select(key, F.col(value).alias("_a"), F.lit(True).alias("_ia")).join(b.select(key, F.col(value).alias("_b"), F.lit(True).alias("_ib")), key, "full_outer")
    return j.select(key, F.when(F.col("_ib").isNull(), "only_a").when(F.col("_ia").isNull(), "only_b").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("differs").alias("state"))


def count_consistency(parents: DataFrame, children: DataFrame, parent_id: str, child_ref: str, declared: str, width: int = 15) -> DataFrame:
    """``(parent_id, declared, counted)`` where a parent's stored number of children is not the counted one; ids agree by their first ``width`` characters."""
    short = lambda c: F.left(c, F.lit(width))
    n = children.where(F.col(child_ref).isNotNull()).groupBy(short(child_ref).alias("_k")).agg(F.count(F.lit(1)).alias("counted"))
    j = parents.withColumn("_k", short(parent_id)).join(n, "_k", "left").na.fill(0, ["counted"])
    return j.where(~F.col(declared).eqNullSafe(F.col("counted"))).select(parent_id, declared, "counted")


def trigram_candidates(rows: DataFrame, queries: DataFrame, key: str, text: str, query: str, least: float = 0.3) -> DataFrame:
    """``(query, key, similarity)`` of texts that share trigrams with a query, by an inverted index; padded as trigram indexes do.

    Only rows that share a trigram meet, and what is counted is sums, so no product is made.
    """
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) + 1), lambda i: F.substring(F.concat(F.lit("  "), F.lower(c), F.lit(" ")), i, F.lit(3))))
    side = lambda df, name, col: df.where(F.col(col).isNotNull()).select(F.col(name), grams(F.col(col)).alias("g")).withColumn("n", F.size("g")).select(name, "n", F.explode("g").alias("g"))
    a = side(rows, key, text).withColumnRenamed("n", "na")
    b = side(queries.select(F.col(query).alias("_q"), F.col(query).alias("_t")), "_q", "_t").withColumnRenamed("n", "nb")
    both = a.join(b, "g").groupBy("_q", key, "na", "nb").agg(F.count(F.lit(1)).alias("k"))
    return both.select(F.col("_q").alias("query"), key, (F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))).alias("similarity")).where(F.col("similarity") >= least)


def structured_subject(subject: Column, prefix: str, noise: list[str]) -> Column:
    """confirmed for three tokens after the prefix, candidate for the prefix alone, noise for listed forms, else none."""
    bad = F.coalesce(subject.rlike("|".join(f"(?:{n})" for n in noise)), F.lit(False)) if noise else F.lit(False)
    three = rf"{prefix}[\s　]*([^\s　/／|]+)[\s　/／|]+([^\s　/／|]+)[\s　/／|]+([^\s　/／|]+)"
    return F.when(bad, "noise").when(subject.rlike(three), "confirmed").when(subject.rlike(prefix), "candidate").otherwise("none")


def synthesize_signals(declared: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """``(key, state, divergent)`` of declared and observed signals (key, signal, strength): one strong signal or two weaker ones hold; sides that disagree diverge."""
    side = lambda df, n: df.groupBy(key).agg(F.max("strength").alias(f"top_{n}"), F.count_if(F.col("strength") >= 1).alias(f"n_{n}"))
    j = side(declared, "d").join(side(observed, "o"), key, "full_outer").na.fill(0)
    holds = (F.greatest("top_d", "top_o") >= 2) | (F.col("n_d") + F.col("n_o") >= 2)
    return j.select(key, F.when(holds, "holds").otherwise("open").alias("state"), ((F.col("n_d") > 0) != (F.col("n_o") > 0)).alias("divergent"))


def gold_check(gold: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """``(key, ok, reason)``: whether predictions keep a gold set's expected action, allowed and forbidden signals and links that must not be.

    ``gold``: key, expected, forbidden (array), must_not_link; ``predicted``: key, action, signals (array), linked.
    """
    j = gold.join(predicted, key, "left")
    reason = F.when(F.col("action").isNull(), "no_prediction").when(F.coalesce(F.col("must_not_link") & F.col("linked"), F.lit(False)), "forbidden_link").when(F.col("action") != F.col("expected"), "other_action").when(F.coalesce(F.arrays_overlap("signals", "forbidden"), F.lit(False)), "forbidden_signal")
    return j.select(key, reason.isNull().alias("ok"), reason.alias("reason"))
