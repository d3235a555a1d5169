"""Queries of text evidence, revisions, vocabulary hubs, schema checks and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.schema import schema_errors
from folioforge.operators import evidence as E
from folioforge.operators import ledger as L
from folioforge.operators.hubs import term_hubs
from folioforge.operators.revisions import revision_deltas
from folioforge.operators.vocabulary import match_rates
from folioforge.plans import sqltext as Q
from folioforge.plans.operations import sql_values, values
from folioforge.runtime import shared_dir, table
from folioforge.streaming import events as V

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


SAMPLE = [(-1, "最高裁昭和48年12月12日大法廷判決・民集27巻11号1536頁の趣旨に照らし、これを踏襲する。"), (-2, "東京高判平成10年3月4日は事案を異にする。"), (-3, "所論は、最判平成3年4月5日に係る判例違反をいう。"), (-4, "東京地裁平成2年1月1日の記録。")]
_CUE = lambda c, k: "CASE " + " ".join(f"WHEN regexp_matches({c}, {Q.quoted(cue[1])}) THEN {Q.quoted(cue[k])}" for cue in E.CUES) + " END"


@query(f"""WITH docs AS (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {sql_values(SAMPLE)})), s AS (SELECT doc_id, string_split(text, '。') p FROM docs WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(len(p))) n, p FROM s),
v AS (SELECT doc_id, n, p[n + 1] || CASE WHEN n < len(p) - 1 THEN '。' ELSE '' END AS sentence FROM u), f AS (SELECT doc_id, sentence, sentence || coalesce(lead(sentence) OVER (PARTITION BY doc_id ORDER BY n), '') win FROM v WHERE sentence <> ''),
c AS (SELECT *, unnest(regexp_extract_all(sentence, {Q.quoted(E.CITATION)})) citation FROM f), g AS (SELECT *, regexp_extract(citation, {Q.quoted(E.CITATION)}, 1) court, regexp_extract(citation, {Q.quoted(E.CITATION)}, 3) d, regexp_extract(citation, {Q.quoted(E.CITATION)}, 4) r FROM c),
k AS (SELECT *, coalesce({_CUE('sentence', 0)}, {_CUE('win', 0)}) pid, coalesce({_CUE('sentence', 2)}, {_CUE('win', 2)}) rel, coalesce({_CUE('sentence', 3)}, {_CUE('win', 3)}) conf FROM g WHERE d <> '' OR r <> '' OR regexp_matches(court, '[判決]$')),
a AS (SELECT *, coalesce(rel IN ({', '.join(map(Q.quoted, E.ARGUMENT_SENSITIVE))}) AND regexp_matches(win, {Q.quoted(E.PARTY_ARGUMENT)}), false) argued FROM k)
SELECT DISTINCT doc_id, citation, court, CASE WHEN rel IS NULL OR argued THEN 'cited' ELSE rel END treatment, CASE WHEN rel IS NULL THEN 'cited_default' WHEN argued THEN pid || '+argued_party_suppressed' ELSE pid END pattern_id, CASE WHEN rel IS NULL OR argued THEN 'low' ELSE conf END confidence FROM a""")
def citations_treatments(spark: SparkSession, d: str) -> DataFrame:
    """Citations in all documents and in a worked sample, with their treatment."""
    docs = table(spark, d, "documents").select("doc_id", "text").union(values(spark, SAMPLE, "doc_id long, text string"))
    return E.treatments(docs, "doc_id", "text").select("doc_id", "citation", "court", "treatment", "pattern_id", "confidence").distinct()


#: events stand for treatments of a provision: whose it is, what it says
_AS = {"click": "followed", "view": "cited", "purchase": "applied", "error": "overruled", "signup": "limited"}
_VALUE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _AS.items()) + " END"
_MAP = ", ".join(f"('{s}', '{v}', '{n}')" for s, v, n in E.STANCES)
CLAIM_SQL = f"c AS (SELECT event_id k, user_id target, 'treatment_relation' src, {_VALUE} val, 1 + event_id % 3 tier FROM events), m(src, val, stance) AS (VALUES {_MAP}), s AS (SELECT c.*, coalesce(stance, 'unknown') stance FROM c LEFT JOIN m USING (src, val))"


def _claims(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "events").select(F.col("event_id").alias("k"), F.col("user_id").alias("target"), F.lit("treatment_relation").alias("src"), F.expr(_VALUE).alias("val"), (1 + F.col("event_id") % 3).alias("tier"))
    return c.withColumn("stance", E.stance(F.col("src"), F.col("val")))


@query(f"WITH {CLAIM_SQL} SELECT k, stance FROM s")
def stance_map(spark: SparkSession, d: str) -> DataFrame:
    """The stance of each claim."""
    return _claims(spark, d).select("k", "stance")


@query(f"""WITH {CLAIM_SQL}, x AS (SELECT *, CASE WHEN stance = 'continues' THEN 'continuity' WHEN stance IN ('changed', 'qualified', 'disputed') THEN 'change' END side FROM s), g AS (SELECT target, min(k) FILTER (WHERE side = 'continuity') c, min(k) FILTER (WHERE side = 'change') h FROM x GROUP BY 1)
SELECT k, CASE WHEN c IS NOT NULL AND h IS NOT NULL AND side IS NOT NULL THEN 'disputed' ELSE 'candidate' END status, CASE WHEN c IS NOT NULL AND h IS NOT NULL THEN CASE side WHEN 'continuity' THEN h WHEN 'change' THEN c END END counter_key FROM x JOIN g USING (target)""")
def dispute_sides(spark: SparkSession, d: str) -> DataFrame:
    """Which claims stand against each other."""
    return E.disputes(_claims(spark, d), "k", "target", "stance", "tier")[1].select("k", "status", "counter_key")


@query(f"""WITH {CLAIM_SQL}, g AS (SELECT target, count_if(stance = 'continues')::BIGINT n_continuity, count_if(stance IN ('changed', 'qualified', 'disputed'))::BIGINT n_change FROM s GROUP BY 1) SELECT target, n_continuity, n_change, CASE WHEN n_continuity > 0 AND n_change > 0 THEN 'disputed' WHEN n_continuity > 0 THEN 'one_sided_continuity' WHEN n_change > 0 THEN 'one_sided_change' ELSE 'no_signal' END disposition FROM g""")
def provision_views(spark: SparkSession, d: str) -> DataFrame:
    """How the claims about each provision lie."""
    v = E.provision_views(_claims(spark, d).withColumn("source", F.lit("court")), "target", "k", "stance", "source", "tier")
    return v.select("target", "n_continuity", "n_change", "disposition")


OLD = [("civ", "art:1", "1", "目的", "この法律は取引の安全を目的とする。", False), ("civ", "art:2", "2", None, "代理人は本人のために行為をし、その効果は本人に帰属する。相手方は催告をすることができる。", False), ("civ", "art:3", "3", None, "債務者は期限の到来した時から遅滞の責任を負う。", False), ("civ", "art:4", "4", None, "保証人は主たる債務者がその債務を履行しないときに責任を負う。", False), ("civ", "art:5", "5", None, "旧規定。", False)]
NEW = [("civ", "art:1", "1", "目的", "この法律は取引の安全を目的とする。", False), ("civ", "art:2", "2", None, "代理人は本人のために行為をし、その効果は本人に帰属する。", False), ("civ", "art:2-2", "2-2", None, "相手方は催告をすることができる。", False), ("civ", "art:4", "4", None, "債務者は期限の到来した時から遅滞の責任を負う。", False), ("civ", "art:5", "5", None, None, True), ("civ", "art:6", "6", None, "保証人は主たる債務者がその債務を履行しないときに責任を負う。", False)]
ARTICLE = "law_id string, article_path string, article_number string, caption string, text string, deleted boolean"


#: worked out by hand: art:2 gives off its second sentence, art:3 and art:4 move to new numbers, art:5 becomes a shell
GOLD_DELTAS = [("civ", "art:1", "no_change", ""), ("civ", "art:2", "split", "art:2,art:2-2"), ("civ", "art:3", "renumber", "art:4"), ("civ", "art:4", "renumber", "art:6"), ("civ", "art:5", "repeal", "")]


@query(f"SELECT * FROM (VALUES {sql_values(GOLD_DELTAS)}) t(law_id, article_path, delta_kind, counterparts)")
def lawdelta_kinds(spark: SparkSession, d: str) -> DataFrame:
    """What changed between two revisions, against a result worked out by hand."""
    out = revision_deltas(values(spark, OLD, ARTICLE), values(spark, NEW, ARTICLE))
    return out.select("law_id", "article_path", "delta_kind", F.array_join("counterpart_paths", ",").alias("counterparts"))


TERMS = [("t1", "A", "101", "1", "善意", "ぜんい", "ある事実を知らないこと。法律上の用語である。"), ("t2", "B", "101", "1", "善意", "ゼンイ", "知らないこと"), ("t3", "A", "101", "1", "善意", "ぜんい", "他人のためを思う気持ちをいう日常語。"), ("t4", "B", "102", "1", "善意", None, "事実を知らない"), ("t5", "C", "110", "1", "善意", "ぜんい", None), ("t6", "C", "110", "1", "悪意", "あくい", None), ("t7", "A", "100a", "2", "悪意", "あくい", "x"), ("t8", "A", "100a", "1", "遺言", "いごん", "死後の財産の処分を定める意思表示。")]


#: worked out by hand: (term, anchor of its hub, how it came there)
GOLD_HUBS = [("t1", "t1", "skos_exact_match"), ("t2", "t1", "skos_exact_match"), ("t3", "t3", "homograph_split"), ("t4", "t1", "reading_missing_def_match"), ("t5", "t1", "skos_close_match"), ("t6", "t6", "specialty_seed"), ("t7", None, "left_out"), ("t8", "t8", "bedrock_seed")]


def _terms(spark: SparkSession) -> DataFrame:
    return values(spark, TERMS, "term_id string, scheme_id string, authority_rank string, term_tier string, pref string, reading string, definition string")


@query(f"SELECT * FROM (VALUES {sql_values(GOLD_HUBS)}) t(term_id, anchor_id, map_type)")
def vocab_hubs(spark: SparkSession, d: str) -> DataFrame:
    """Terms of three dictionaries in hubs, against a result worked out by hand."""
    return term_hubs(_terms(spark)).select("term_id", "anchor_id", "map_type")


@query("""WITH t AS (SELECT DISTINCT alias_term p FROM dict_aliases), h AS (SELECT DISTINCT 依頼者 p FROM dict_attorney_prior) SELECT count(*) terms, count(h.p) full_key, count(h.p) head_only_bound, 0::BIGINT lost_by_reading FROM t LEFT JOIN h USING (p)""")
def vocab_match_rates(spark: SparkSession, d: str) -> DataFrame:
    """How many alias terms the other dictionary knows."""
    a = table(spark, d, "dict_aliases").select(F.col("alias_term").alias("pref"), F.lit(None).cast("string").alias("reading")).distinct()
    b = table(spark, d, "dict_attorney_prior").select(F.col("依頼者").alias("pref"), F.lit(None).cast("string").alias("reading")).distinct()
    x = a.withColumn("raw", F.col("pref"))
    return match_rates(x, b.withColumn("raw", F.col("pref")), "pref", "reading", key="raw")


PROPS = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 50}}}


@query("SELECT '$.k: range' AS error, count(*) AS n FROM events WHERE (props::JSON->>'$.k')::INT NOT BETWEEN 0 AND 50 HAVING count(*) > 0")
def event_schema_errors(spark: SparkSession, d: str) -> DataFrame:
    """Errors of the events' properties, by kind."""
    e = table(spark, d, "events").select(F.explode(schema_errors(F.col("props"), PROPS)).alias("error"))
    return e.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def _events(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@query("""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) g FROM o)
SELECT user_id, count(*) n FROM s GROUP BY user_id, g""")
def session_batch(spark: SparkSession, d: str) -> DataFrame:
    """Sessions that half an hour's pause ends."""
    return V.sessions(_events(table(spark, d, "events")), "ts", "user_id", "30 minutes").select("user_id", "n")


@query("""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) g FROM o)
SELECT user_id, count(*) n FROM s GROUP BY user_id, g""")
def stream_session(spark: SparkSession, d: str) -> DataFrame:
    """The same sessions, through a stream."""
    schema = table(spark, d, "events").schema
    stream = _events(V.read_events(spark, f"{d}/events.parque[t]", schema))
    return V.run_to_table(V.sessions(stream, "ts", "user_id", "30 minutes"), f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}").select("user_id", "n")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) n, round(sum(value), 4) total FROM events GROUP BY 1, 2")
def tumbling_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events by hour and type."""
    t = V.tumbling(_events(table(spark, d, "events")), "ts", "event_type", "1 hour")
    return t.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) SELECT user_id, min(event_id) broken_at FROM n WHERE event_id % 97 = 5 GROUP BY 1")
def hash_chain_verify(spark: SparkSession, d: str) -> DataFrame:
    """Where the ledgers of all users break after a value in some of their rows was changed."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    start = e.select("user_id").distinct().withColumn("own", F.lit(""))
    ledger = L.append_chained(start, e, "user_id", "event_id", ["event_id", "event_type", "value"], "prev", "own")
    tampered = ledger.withColumn("value", F.when(F.col("event_id") % 97 == 5, F.col("value") + 1).otherwise(F.col("value")))
    return L.chain_breaks(tampered, "user_id", "event_id", ["event_id", "event_type", "value"], "prev", "own")
