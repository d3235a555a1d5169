"""Queries of demand, ledgers, gates, health and operations, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import concordance as C
from folioforge.operators import ledger as L
from folioforge.operators import profiles as P
from folioforge.plans.library import HELD_SQL, NODES_SQL, nodes
from folioforge.runtime import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table."""
    return spark.createDataFrame(rows, schema)


def sql_values(rows: list[tuple]) -> str:
    cell = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)
    return ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)


# ------------------------------------------------------------------ demand and recommendation
#: genres as the test tables write them; the house list is profiles.GENRE_TO_DOMAIN
GENRES = [*P.GENRE_TO_DOMAIN.items(), ("民事", "civil"), ("商事", "commercial"), ("行政", "administrative"), ("刑事", "criminal"), ("知財", "ip"), ("労働", "labor"), ("税務", "tax"), ("倒産", "procedure"), ("家事", "civil"), ("金融", "commercial"), ("国際", "international")]
TAGS = [("民法", "civil"), ("相続法", "civil"), ("家事事件", "civil"), ("不動産登記", "civil"), ("会社法", "commercial"), ("M&A", "commercial"), ("金融商品取引", "commercial"), ("商標", "ip"), ("知的財産", "ip"), ("著作権", "ip"), ("労働法", "labor"), ("租税法", "tax"), ("刑事手続", "criminal"), ("少年事件", "criminal"), ("行政法", "administrative"), ("地方自治", "administrative"), ("民事執行", "procedure"), ("倒産法", "procedure")]
OUT = ["unknown", "unclassified"]

SHARE_SQL = f"""gm(g, dm) AS (VALUES {sql_values(GENRES)}), hold AS (SELECT DISTINCT upper(trim(internal_id)) id, genre FROM holdings WHERE internal_id IS NOT NULL),
l AS (SELECT DISTINCT id, genre, dm FROM (SELECT id, genre, unnest(genre) g FROM hold) JOIN gm USING (g)), w AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY id, genre) w FROM l), share AS (SELECT dm AS label, sum(w) weight, sum(w) / sum(sum(w)) OVER () share FROM w GROUP BY 1)"""


def _share(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "holdings").where("internal_id is not null").select(F.upper(F.trim("internal_id")).alias("id"), "genre").distinct()
    to = F.create_map(*[F.lit(x) for pair in GENRES for x in pair])
    return P.fractional_share(held.withColumn("domains", F.transform("genre", lambda g: to[g])), "id", "domains")


@query(f"WITH {SHARE_SQL} SELECT label, round(weight, 4) weight, round(share, 6) share FROM share")
def demand_share(spark: SparkSession, d: str) -> DataFrame:
    """How the holdings spread over domains."""
    return _share(spark, d).select("label", F.round("weight", 4).alias("weight"), F.round("share", 6).alias("share"))


@query(f"WITH {SHARE_SQL} SELECT label, round(share, 6) share FROM share ORDER BY share DESC")
def demand_summary(spark: SparkSession, d: str) -> DataFrame:
    """Domains by share."""
    return _share(spark, d).select("label", F.round("share", 6).alias("share")).orderBy(F.desc("share"))


PROFILE_SQL = f"""tm(tag, dm) AS (VALUES {sql_values(TAGS)}), cand AS (SELECT DISTINCT id, primary_domain, domain_hits, tags, total_toc, matched_toc, coverage, title FROM candidates), one AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(total_toc, -1) DESC, coalesce(primary_domain, ''), title) k FROM cand), c1 AS (SELECT * FROM one WHERE k = 1),
parts AS (SELECT id, primary_domain dm, 2.0::DOUBLE w FROM c1 UNION ALL SELECT id, u.key, u.value FROM (SELECT id, unnest(map_entries(domain_hits)) u FROM c1) UNION ALL SELECT id, dm, 1.0 FROM (SELECT id, unnest(tags) tag FROM c1) JOIN tm USING (tag)),
prof0 AS (SELECT id, dm, sum(w) w FROM parts WHERE dm IS NOT NULL AND dm <> '' AND dm NOT IN ('unknown', 'unclassified') GROUP BY 1, 2), prof AS (SELECT id, dm AS domain, w / sum(w) OVER (PARTITION BY id) weight, sum(w) OVER (PARTITION BY id) t FROM prof0)"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    c = table(spark, d, "candidates")
    order = [F.desc(F.coalesce("total_toc", F.lit(-1))), F.coalesce("primary_domain", F.lit("")), "title"]
    return c.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy(*order))).where("k = 1").drop("k")


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return P.candidate_profiles(_candidates(spark, d), values(spark, TAGS, "tag string, domain string"), key="id", out_of_domain=OUT)


@query(f"WITH {PROFILE_SQL} SELECT id, domain, round(weight, 6) weight FROM prof WHERE t > 0")
def candidate_profile(spark: SparkSession, d: str) -> DataFrame:
    """Each candidate's domains."""
    return _profiles(spark, d).select("id", "domain", F.round("weight", 6).alias("weight"))


@query(f"""WITH {PROFILE_SQL}, s AS (SELECT id, coalesce(primary_domain NOT IN ('', 'unknown', 'unclassified'), false) OR len(list_filter(map_keys(coalesce(domain_hits, MAP {{}})), lambda x: x NOT IN ('', 'unknown', 'unclassified'))) > 0 toc, len(list_filter(coalesce(tags, []), lambda x: x IN ({', '.join("'" + t + "'" for t, _ in TAGS)}))) > 0 tag, matched_toc, coverage FROM c1)
SELECT id, CASE WHEN toc AND tag THEN 'mixed' WHEN toc THEN 'toc_term_dict' WHEN tag THEN 'tag_domain_fallback' ELSE 'unclassified' END source, CASE WHEN toc AND coalesce(matched_toc, 0) >= 5 AND coalesce(coverage, 0) >= 0.05 THEN 'high' WHEN toc THEN 'medium' ELSE 'low' END confidence FROM s""")
def profile_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Where each profile comes from and how sure it is."""
    inside = lambda c: ~c.isin("", *OUT)
    toc = F.coalesce(inside(F.col("primary_domain")), F.lit(False)) | F.coalesce(F.exists(F.map_keys("domain_hits"), inside), F.lit(False))
    tag = F.coalesce(F.exists("tags", lambda t: t.isin([t for t, _ in TAGS])), F.lit(False))
    source, confidence = P.profile_source(toc, tag, F.col("matched_toc"), F.col("coverage"))
    return _candidates(spark, d).select("id", source.alias("source"), confidence.alias("confidence"))


@query(f"""WITH {SHARE_SQL}, {PROFILE_SQL}, rel AS (SELECT id, sum(coalesce(share, 0) * p.weight) rel FROM prof p LEFT JOIN share ON label = domain WHERE t > 0 GROUP BY 1),
raw AS (SELECT c1.id, rel * (1 + 0.25 * ln(1 + greatest(coalesce(total_toc, 0), 0))) * CASE WHEN coalesce(contains(title, '実務大系') OR contains(title, 'コンメンタール'), false) OR coalesce(total_toc, 0) >= 200 THEN 1.25 ELSE 1 END raw FROM c1 JOIN rel USING (id)),
top AS (SELECT id, round(raw, 6) raw FROM raw ORDER BY round(raw, 6) DESC, id LIMIT 50) SELECT id, row_number() OVER (ORDER BY raw DESC, id) AS rank, round(100 * raw / max(raw) OVER (), 2) AS score FROM top""")
def recommend_topn(spark: SparkSession, d: str) -> DataFrame:
    """The fifty best candidates."""
    rel = P.relevance(_profiles(spark, d), _share(spark, d), "id")
    keyword = F.col("title").contains("実務大系") | F.col("title").contains("コンメンタール")
    raw = _candidates(spark, d).join(rel, "id").select("id", F.round(F.col("relevance") * P.flagship_weight(F.col("total_toc"), keyword), 6).alias("raw"))
    return P.ranked(raw, "raw", ["id"], 50).select("id", "rank", "score")


PREFIXES = P.NDC_PREFIX_TO_DOMAIN


@query(f"""WITH p(prefix, subject) AS (VALUES {sql_values(PREFIXES)}), n AS (SELECT DISTINCT code FROM (SELECT unnest(ndc) code FROM holdings)), j AS (SELECT code, subject, row_number() OVER (PARTITION BY code ORDER BY length(prefix) DESC NULLS LAST) k FROM n LEFT JOIN p ON starts_with(code, prefix)) SELECT code, subject FROM j WHERE k = 1""")
def longest_prefix_map(spark: SparkSession, d: str) -> DataFrame:
    """The subject of each class number by its longest known prefix."""
    codes = table(spark, d, "holdings").select(F.explode("ndc").alias("code")).distinct()
    return P.longest_prefix(codes, "code", PREFIXES, "subject").select("code", "subject")


@query("""WITH c AS (SELECT source, lang, doc_kind, count(*) n FROM documents WHERE lang IS NOT NULL GROUP BY ALL), k AS (SELECT lang, doc_kind, sum(n)::BIGINT n FROM c GROUP BY 1, 2), g AS (SELECT lang, sum(n)::BIGINT size, max(n) FILTER (WHERE doc_kind IS NOT NULL) most, count_if(n >= 5 AND doc_kind IS NOT NULL)::BIGINT parts FROM k GROUP BY 1) SELECT * FROM g WHERE size >= 50 AND most / size < 0.5 AND parts >= 4""")
def catchall_folders(spark: SparkSession, d: str) -> DataFrame:
    """Languages that hold documents of many kinds, none of them in the majority."""
    return P.catch_all(table(spark, d, "documents"), "lang", "doc_kind", least=50, part_least=5)


# ------------------------------------------------------------------ ledgers
@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) k FROM events) WHERE k = 1 AND user_id IS NOT NULL")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user."""
    return L.latest_state(table(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("SELECT user_id, event_type, CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 3 END urgency FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) k FROM events) WHERE k = 1 AND event_type <> 'purchase' AND user_id IS NOT NULL ORDER BY urgency, user_id")
def unreflected_queue(spark: SparkSession, d: str) -> DataFrame:
    """Latest states that still wait, most urgent first."""
    last = L.latest_state(table(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_type"])
    return last.where("event_type <> 'purchase'").withColumn("urgency", F.expr("CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 3 END")).orderBy("urgency", "user_id")


FOLD_SQL = """m AS (SELECT user_id, ts, event_id, epoch(ts) e, CASE event_type WHEN 'signup' THEN 'enter' WHEN 'purchase' THEN 'release' WHEN 'error' THEN 'escape' WHEN 'click' THEN 'recur' END tr, event_type FROM events WHERE event_type <> 'view'),
b AS (SELECT *, last_value(CASE WHEN tr <> 'escape' THEN tr END IGNORE NULLS) OVER w last, coalesce(max(CASE WHEN tr = 'release' THEN 1 ELSE 0 END) OVER w, 0) seen FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, tr = 'recur' OR (tr = 'enter' AND seen = 1 AND NOT coalesce(last IN ('enter', 'recur'), false)) again, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) n FROM b),
g AS (SELECT user_id, max(n) FILTER (WHERE tr IN ('enter', 'recur')) o, max(n) FILTER (WHERE tr = 'release') c, bool_or(tr IN ('enter', 'recur')) entered, bool_or(tr = 'release') released, bool_or(again) recurred, count_if(tr = 'escape') escapes, count(*) entries FROM r GROUP BY 1),
f AS (SELECT g.*, o IS NOT NULL AND (c IS NULL OR o > c) open, (SELECT e FROM r WHERE r.user_id = g.user_id AND r.n = g.o) since FROM g)"""


def _folded(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_type <> 'view'").withColumn("tr", F.expr("CASE event_type WHEN 'signup' THEN 'enter' WHEN 'purchase' THEN 'release' WHEN 'error' THEN 'escape' WHEN 'click' THEN 'recur' END"))
    e = e.withColumn("epoch", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return L.quarantine_fold(e, "user_id", ["ts", "event_id"], "tr", "epoch", "event_type")


@query(f"""WITH {FOLD_SQL} SELECT sum(entries)::BIGINT entries, count_if(entered)::BIGINT distinct_items, count_if(open)::BIGINT open_count, count_if(released)::BIGINT released_count, round(coalesce(avg(CASE WHEN open THEN greatest(0, (1735689600 - since) / 86400) END), 0), 4) mean_age_days, round(coalesce(max(CASE WHEN open THEN greatest(0, (1735689600 - since) / 86400) END), 0), 4) max_age_days,
sum(escapes)::BIGINT escape_events, round(sum(escapes) / greatest(count_if(entered), 1), 4) escape_rate, round(count_if(recurred) / greatest(count_if(released), 1), 4) recurrence_rate FROM f""")
def quarantine_kpi(spark: SparkSession, d: str) -> DataFrame:
    """Figures of the quarantine fold over all users."""
    k = L.quarantine_kpi(_folded(spark, d), 1_735_689_600.0)
    return k.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in k.dtypes])


@query(f"WITH {FOLD_SQL} SELECT user_id, open, coalesce(recurred, false) recurred, escapes::BIGINT escapes FROM f")
def quarantine_items(spark: SparkSession, d: str) -> DataFrame:
    """The quarantine state of each user."""
    return _folded(spark, d).select("user_id", "open", F.coalesce("recurred", F.lit(False)).alias("recurred"), "escapes")


@query("""WITH f AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') a, min(ts) FILTER (WHERE event_type = 'purchase') b FROM events GROUP BY 1)
SELECT count(*) users, count(a) signed, count_if(b > a)::BIGINT bought, round(median((epoch_us(b) - epoch_us(a)) / 1e6) FILTER (WHERE b > a), 3) AS median_seconds FROM f""")
def funnel_latency(spark: SparkSession, d: str) -> DataFrame:
    """From signup to first purchase."""
    first = lambda t: F.min(F.when(F.col("event_type") == t, F.unix_micros(F.col("ts").cast("timestamp"))))
    f = table(spark, d, "events").groupBy("user_id").agg(first("signup").alias("a"), first("purchase").alias("b"))
    return f.agg(F.count(F.lit(1)).alias("users"), F.count("a").alias("signed"), F.count_if(F.col("b") > F.col("a")).alias("bought"), F.round(F.median(F.when(F.col("b") > F.col("a"), (F.col("b") - F.col("a")) / 1e6)), 3).alias("median_seconds"))


@query("SELECT event_type, count_if((props::JSON->>'$.k')::INT >= 50)::BIGINT high, count(*) n FROM events GROUP BY 1")
def json_extract_filter(spark: SparkSession, d: str) -> DataFrame:
    """A number inside the properties, by type."""
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.get_json_object("props", "$.k").cast("int") >= 50).alias("high"), F.count(F.lit(1)).alias("n"))


@query("""WITH g AS (SELECT DISTINCT internal_id id, to_json([isbn, publisher])::VARCHAR j FROM holdings UNION ALL SELECT event_id::VARCHAR, props FROM events), u AS (SELECT id, unnest(CASE WHEN json_type(j::JSON) = 'ARRAY' THEN from_json(j::JSON, '["VARCHAR"]') ELSE [] END) v FROM g) SELECT id, v FROM u WHERE regexp_matches(v, '^[0-9]+$')""")
def jsonb_array_guard(spark: SparkSession, d: str) -> DataFrame:
    """Numeric texts of values that are arrays (holdings' fields); objects (events' properties) give nothing."""
    g = table(spark, d, "holdings").select(F.col("internal_id").alias("id"), F.to_json(F.array("isbn", "publisher")).alias("j")).distinct().union(table(spark, d, "events").select(F.col("event_id").cast("string"), "props"))
    items = F.when(F.ltrim("j").startswith("["), F.from_json("j", "array<string>"))
    return g.select("id", F.explode(F.coalesce(items, F.array().cast("array<string>"))).alias("v")).where("v rlike '^[0-9]+$'")


# ------------------------------------------------------------------ gates, health, repair
FIELDS = ["isbn", "bencom_id", "title", "title_norm", "author", "author_norm", "publisher", "publisher_norm", "source_record_hash"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count_if(coalesce(trim({c}) <> '', false))::BIGINT filled, count(*) total, round(100.0 * count_if(coalesce(trim({c}) <> '', false)) / nullif(count(*), 0), 1)::DOUBLE AS percent FROM holdings" for c in FIELDS))
def fill_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many holdings fill each field."""
    return P.fill_rates(table(spark, d, "holdings"), FIELDS)


@query("""SELECT o_orderkey, 'known_status' AS rule FROM orders WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), false) UNION ALL SELECT o_orderkey, 'urgent_is_open' FROM orders WHERE NOT coalesce(o_orderpriority <> '1-URGENT' OR o_orderstatus = 'O', false) UNION ALL SELECT o_orderkey, 'positive_total' FROM orders WHERE NOT coalesce(o_totalprice > 0, false)""")
def domain_check_violations(spark: SparkSession, d: str) -> DataFrame:
    """Orders outside their domains."""
    c = F.col
    return L.violations(table(spark, d, "orders"), "o_orderkey", {"known_status": c("o_orderstatus").isin("F", "O"), "urgent_is_open": (c("o_orderpriority") != "1-URGENT") | (c("o_orderstatus") == "O"), "positive_total": c("o_totalprice") > 0})


@query("""WITH c AS (SELECT DISTINCT id, primary_domain, total_toc, matched_toc, coverage, publisher FROM candidates) SELECT id, 'matched_within_total' AS rule FROM c WHERE NOT coalesce(matched_toc <= total_toc, false) UNION ALL SELECT id, 'coverage_needs_total' FROM c WHERE NOT coalesce(coverage IS NULL OR total_toc > 0, false) UNION ALL SELECT id, 'domain_known' FROM c WHERE NOT coalesce(primary_domain NOT IN ('unknown', 'unclassified'), false)""")
def sql_gate_union(spark: SparkSession, d: str) -> DataFrame:
    """Gate violations of the candidates, every branch in one table."""
    c = F.col
    rows = table(spark, d, "candidates").select("id", "primary_domain", "total_toc", "matched_toc", "coverage", "publisher").distinct()
    return L.violations(rows, "id", {"matched_within_total": c("matched_toc") <= c("total_toc"), "coverage_needs_total": c("coverage").isNull() | (c("total_toc") > 0), "domain_known": ~c("primary_domain").isin(OUT)})


@query("""WITH m AS (SELECT isbn AS code, left(book_id, 2) AS part, title AS name, book_id AS ref FROM books), h AS (SELECT *, md5(concat_ws(chr(31), coalesce(code, chr(1)), coalesce(part, chr(1)), coalesce(name, chr(1)), coalesce(ref, chr(1)))) row_hash, count(*) OVER (PARTITION BY code) c FROM m)
SELECT code, ref, row_hash, CASE WHEN coalesce(regexp_matches(code, '^[0-9]{13}$') AND left(code, 3) = '979' AND c = 1, false) THEN 'clean' ELSE 'quarantined' END quality FROM h""")
def landing_validate(spark: SparkSession, d: str) -> DataFrame:
    """Landed books by the quality of their code (form, prefix, used once), with their hashes."""
    m = table(spark, d, "books").select(F.col("isbn").alias("code"), F.left("book_id", F.lit(2)).alias("part"), F.col("title").alias("name"), F.col("book_id").alias("ref"))
    once = m.groupBy("code").agg((F.count(F.lit(1)) == 1).alias("once"))
    j = m.join(once, m["code"].eqNullSafe(once["code"]), "left").drop(once["code"])
    good = F.col("code").rlike("^[0-9]{13}$") & (F.left("code", F.lit(3)) == "979") & F.col("once")
    return j.select("code", "ref", X.stable_hash(*[F.col(x) for x in m.columns]).alias("row_hash"), F.when(F.coalesce(good, F.lit(False)), "clean").otherwise("quarantined").alias("quality"))


RUNS_SQL = """ro AS (SELECT load_run_id, row_number() OVER (ORDER BY loaded_at, load_run_id) s FROM load_run),
rec AS (SELECT s, upper(trim(internal_id)) id, title, author, publisher, isbn, has_toc, lower(regexp_replace(source_record_hash, '^[A-Za-z0-9]+:', '')) h, ingested_at FROM holdings JOIN ro USING (load_run_id) WHERE trim(internal_id) <> ''),
cur AS (SELECT s, id, max(coalesce(h, md5(concat_ws('|', coalesce(title, ''), coalesce(author, ''), coalesce(publisher, ''))))) h FROM rec GROUP BY 1, 2)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """The records of all load runs with the run's place ``s``."""
    from pyspark.sql.window import Window

    order = table(spark, d, "load_run").select("load_run_id", F.row_number().over(Window.orderBy("loaded_at", "load_run_id")).alias("s"))
    h = table(spark, d, "holdings").join(F.broadcast(order), "load_run_id").where("trim(internal_id) <> ''")
    return h.select("s", F.upper(F.trim("internal_id")).alias("id"), "title", "author", "publisher", "isbn", "has_toc", F.lower(F.regexp_replace("source_record_hash", "^[A-Za-z0-9]+:", "")).alias("h"))


def _states(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c: F.coalesce(c, F.lit(""))
    r = _runs(spark, d)
    return r.groupBy("s", "id").agg(F.max(F.coalesce("h", F.md5(F.concat_ws("|", text("title"), text("author"), text("publisher"))))).alias("h"))


@query(f"WITH {RUNS_SQL}, c AS (SELECT id, s, h, CASE WHEN lag(h) OVER (PARTITION BY id ORDER BY s) = h THEN 0 ELSE 1 END fresh FROM cur) SELECT id, max_by(h, s) row_hash, sum(fresh)::INT AS version FROM c GROUP BY 1")
def versioned_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Every load run merged into the ones before it: the last hash of each record and its version."""
    from functools import reduce

    runs = [r[0] for r in table(spark, d, "load_run").select("load_run_id").distinct().collect()]  # one row a delivery
    of = lambda n: _states(spark, d).where(F.col("s") == n).select("id", F.col("h").alias("row_hash"))
    start = of(1).withColumn("version", F.lit(1))
    return reduce(lambda old, n: L.versioned_upsert(old, of(n), "id", []), range(2, len(runs) + 1), start).select("id", "row_hash", "version")


@query(f"""WITH {RUNS_SQL}, dd AS (SELECT DISTINCT s, id, unnest([CASE WHEN isbn IS NULL THEN 'isbn_absent' END, CASE WHEN publisher IS NULL THEN 'publisher_absent' END, CASE WHEN NOT coalesce(has_toc, false) THEN 'toc_absent' END]) defect FROM rec), x AS (SELECT * FROM dd WHERE defect IS NOT NULL), n AS (SELECT max(s) m FROM ro)
SELECT coalesce(a.s, b.s + 1) s, coalesce(a.id, b.id) id, coalesce(a.defect, b.defect) defect, CASE WHEN a.id IS NULL THEN 'fixed' WHEN b.id IS NULL THEN 'new' ELSE 'persisted' END AS change FROM (SELECT * FROM x, n WHERE s < m) b FULL OUTER JOIN (SELECT * FROM x WHERE s > 1) a ON a.id = b.id AND a.defect = b.defect AND a.s = b.s + 1""")
def regression_diff(spark: SparkSession, d: str) -> DataFrame:
    """Defects of each load run against the one before it."""
    kinds = F.array_compact(F.array(F.when(F.col("isbn").isNull(), F.lit("isbn_absent")), F.when(F.col("publisher").isNull(), F.lit("publisher_absent")), F.when(~F.coalesce("has_toc", F.lit(False)), F.lit("toc_absent"))))
    x = _runs(spark, d).select("s", "id", F.explode(kinds).alias("defect"))
    last = table(spark, d, "load_run").select("load_run_id").distinct().count()
    return L.before_after(x.where(F.col("s") < last).withColumn("s", F.col("s") + 1), x.where("s > 1"), ["s", "id", "defect"])


@query(f"SELECT DISTINCT book_id, 'title' AS field, title AS before, trim(regexp_replace(title, '[ 　]+', ' ', 'g')) AS after FROM books WHERE title <> trim(regexp_replace(title, '[ 　]+', ' ', 'g'))")
def repair_plan(spark: SparkSession, d: str) -> DataFrame:
    """Titles whose blanks would be repaired."""
    b = table(spark, d, "books").select("book_id", "title").distinct()
    return L.repair_plan(b, b.withColumn("title", F.trim(F.regexp_replace("title", "[ 　]+", " "))), ["book_id"], ["title"])


@query(f"""WITH {NODES_SQL}, n AS (SELECT book_id, max(coalesce(depth, 1)) dmax FROM nodes GROUP BY 1), s AS (SELECT book_id, max(k) richest, min(k) least, count(*) srcs FROM (SELECT book_id, toc_source, count(*) k FROM nodes GROUP BY 1, 2) GROUP BY 1),
h AS (SELECT b.book_id, ((coalesce(b.isbn, '') <> '')::INT + (coalesce(b.title, '') <> '')::INT + (coalesce(b.publisher, '') <> '')::INT + (b.author IS NOT NULL)::INT) / 4.0 l1, CASE WHEN dmax IS NULL THEN 0.0 ELSE 0.5 * (dmax >= 2)::INT + 0.5 * (richest >= 5)::INT END l2, 0.3 * (page_offset IS NOT NULL)::INT + 0.2 + 0.2 * coalesce(has_toc, false)::INT + 0.3 * coalesce(page_offset.validated, false)::INT l3, coalesce(srcs >= 2 AND richest / least >= 3, false)::INT open_conflicts FROM books b LEFT JOIN n USING (book_id) LEFT JOIN s USING (book_id))
SELECT book_id, floor((30 * l1 + 40 * l2 + 30 * l3) * CASE WHEN open_conflicts = 0 THEN 1.0 ELSE 0.85 END + 0.001)::INT AS health FROM h""")
def health_score(spark: SparkSession, d: str) -> DataFrame:
    """Health of each book, whole points."""
    per = nodes(spark, d).groupBy("book_id", "toc_source").agg(F.count(F.lit(1)).alias("k"), F.max(F.coalesce("depth", F.lit(1))).alias("dm"))
    s = per.groupBy("book_id").agg(F.max("k").alias("richest"), F.min("k").alias("least"), F.count(F.lit(1)).alias("srcs"), F.max("dm").alias("dmax"))
    b = table(spark, d, "books").join(s, "book_id", "left")
    has = lambda c: (F.coalesce(c, F.lit("")) != "").cast("int")
    on = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    l1 = (has("isbn") + has("title") + has("publisher") + F.col("author").isNotNull().cast("int")) / 4.0
    l2 = F.when(F.col("dmax").isNull(), 0.0).otherwise(0.5 * (F.col("dmax") >= 2).cast("int") + 0.5 * (F.col("richest") >= 5).cast("int"))
    l3 = 0.3 * F.col("page_offset").isNotNull().cast("int") + 0.2 + 0.2 * on(F.col("has_toc")) + 0.3 * on(F.col("page_offset.validated"))
    open_conflicts = on((F.col("srcs") >= 2) & (F.col("richest") / F.col("least") >= 3))
    raw = (30 * l1 + 40 * l2 + 30 * l3) * F.when(open_conflicts == 0, 1.0).otherwise(0.85)
    return b.select("book_id", F.floor(raw + 0.001).cast("int").alias("health"))


# ------------------------------------------------------------------ graphs and operations
EDGES = [("build", "parse"), ("parse", "fetch"), ("report", "build"), ("fetch", "report"), ("publish", "build"), ("notify", "publish")]


@query(f"WITH RECURSIVE e(a, b) AS (VALUES {sql_values(EDGES)}), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT DISTINCT a AS stage FROM r WHERE a = b")
def dag_cycle(spark: SparkSession, d: str) -> DataFrame:
    """Stages that depend on themselves."""
    return L.reachability(values(spark, EDGES, "a string, b string")).where("a = b").select(F.col("a").alias("stage")).distinct()


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'l' || legallib_book_id a, 'c' || canonical_title b FROM resolver WHERE canonical_title IS NOT NULL), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a, a AS m FROM s UNION SELECT r.a, s.b FROM r JOIN s ON r.m = s.a)
SELECT a AS node, min(m) AS component FROM r GROUP BY 1""")
def connected_component(spark: SparkSession, d: str) -> DataFrame:
    """Components of the earlier link decisions."""
    from folioforge.operators.graph import connected_components

    r = table(spark, d, "resolver").where("canonical_title is not null")
    return connected_components(r.select(F.concat(F.lit("l"), "legallib_book_id").alias("a"), F.concat(F.lit("c"), "canonical_title").alias("b")).distinct())


METRICS = [("rows_lost", 0.0, 0.0, True), ("reject_rate", 0.03, 0.02, False), ("errors", None, 1.0, True), ("latency", 3.0, 5.0, False)]


@query(f"""WITH m(item, value, most, hard) AS (VALUES {sql_values(METRICS)}), c AS (SELECT *, coalesce(value <= most, false) ok FROM m) SELECT CASE WHEN bool_or(hard AND NOT ok) THEN 'NO-GO' WHEN bool_or(NOT ok) THEN 'CONDITIONAL' ELSE 'GO' END verdict, string_agg(CASE WHEN NOT ok THEN item END, ',' ORDER BY item) failed FROM c""")
def verdict(spark: SparkSession, d: str) -> DataFrame:
    """GO, CONDITIONAL or NO-GO; a missing figure fails."""
    m = values(spark, METRICS, "item string, value double, most double, hard boolean").withColumn("ok", F.coalesce(F.col("value") <= F.col("most"), F.lit(False)))
    failed = F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("item")))), ",")
    return m.agg(F.when(F.bool_or(F.col("hard") & ~F.col("ok")), "NO-GO").when(F.bool_or(~F.col("ok")), "CONDITIONAL").otherwise("GO").alias("verdict"), failed.alias("failed"))


REF = "([一-龥]{1,10}(?:法|通則|約款))([0-9]+)条"


@query(f"WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '{REF}')) ref FROM documents) SELECT regexp_extract(ref, '{REF}', 1) law, regexp_extract(ref, '{REF}', 2)::INT article, count(*) n, count(DISTINCT doc_id) docs FROM r GROUP BY 1, 2")
def statute_refs(spark: SparkSession, d: str) -> DataFrame:
    """Articles of statutes that the documents cite."""
    refs = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(REF), F.lit(0))).alias("ref"))
    return refs.groupBy(F.regexp_extract("ref", REF, 1).alias("law"), F.regexp_extract("ref", REF, 2).cast("int").alias("article")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))
