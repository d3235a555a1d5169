"""Queries of sections, requests, stages, observations, metrics and rollups, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import operations as W
from folioforge.plans import library as B
from folioforge.plans import operations as O
from folioforge.plans import sqltext as Q
from folioforge.plans.operations import sql_values, values
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


@query("""WITH RECURSIVE n AS (SELECT toc_node_id id, nullif(parent_toc_node_id, '') p, kind FROM (SELECT *, row_number() OVER (PARTITION BY toc_node_id ORDER BY updated_at DESC) k FROM toc_nodes) WHERE k = 1),
w AS (SELECT id, id cur, p, kind, 0 AS d FROM n UNION ALL SELECT w.id, n.id, n.p, n.kind, w.d + 1 FROM w JOIN n ON n.id = w.p WHERE coalesce(w.kind, '') <> 'chapter' AND w.d < 80)
SELECT n.id AS toc_node_id, w.cur AS section FROM n LEFT JOIN w ON w.id = n.id AND w.kind = 'chapter'""")
def nearest_section(spark: SparkSession, d: str) -> DataFrame:
    """The chapter that each node lies in."""
    from folioforge.operators.hierarchy import latest

    n = latest(table(spark, d, "toc_nodes"), "toc_node_id", "updated_at", ["parent_toc_node_id", "kind"]).withColumn("parent", F.nullif("parent_toc_node_id", F.lit("")))
    return W.nearest_of_kind(n, "id", "parent", "kind", "chapter").withColumnRenamed("id", "toc_node_id")


@query("""WITH n AS (SELECT DISTINCT toc_node_id, kind, parent_toc_node_id FROM toc_nodes), k AS (SELECT DISTINCT toc_node_id, coalesce(kind, CASE WHEN toc_node_id IN (SELECT parent_toc_node_id FROM n WHERE parent_toc_node_id IS NOT NULL) THEN 'heading' ELSE 'row' END) kind FROM n) SELECT kind, count(*) n FROM k GROUP BY 1""")
def infer_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Stored kinds, and heading or row where none is stored."""
    n = table(spark, d, "toc_nodes").select("toc_node_id", "kind", "parent_toc_node_id").distinct()
    heads = n.select(F.col("parent_toc_node_id").alias("toc_node_id")).where("toc_node_id is not null").distinct().withColumn("head", F.lit(True))
    k = n.join(heads, "toc_node_id", "left").select("toc_node_id", F.coalesce("kind", F.when(F.col("head"), "heading").otherwise("row")).alias("kind")).distinct()
    return k.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT DISTINCT isbn request_id, title AS stem, id AS expected FROM candidates), x AS (SELECT book_id result_file, isbn rid, title st FROM books), a AS (SELECT rid, min(result_file) f FROM x WHERE rid IS NOT NULL GROUP BY 1), b AS (SELECT st, min(result_file) f FROM x WHERE st IS NOT NULL GROUP BY 1), c AS (SELECT DISTINCT result_file FROM x),
j AS (SELECT request_id, a.f fa, b.f fb, c.result_file fc FROM r LEFT JOIN a ON rid = request_id LEFT JOIN b ON st = stem LEFT JOIN c ON c.result_file = expected)
SELECT request_id, coalesce(fa, fb, fc) result_file, CASE WHEN fa IS NOT NULL THEN 'request_id' WHEN fb IS NOT NULL THEN 'stem' WHEN fc IS NOT NULL THEN 'expected' END matched_by, CASE WHEN coalesce(fa, fb, fc) IS NULL THEN 'pending' ELSE 'answered' END state FROM j
UNION ALL SELECT NULL, result_file, NULL, 'orphan' FROM x WHERE result_file NOT IN (SELECT coalesce(fa, fb, fc) FROM j WHERE coalesce(fa, fb, fc) IS NOT NULL)""")
def roundtrip_match(spark: SparkSession, d: str) -> DataFrame:
    """Wanted books with the registered ones that answer them, and registered ones that nobody wanted."""
    r = table(spark, d, "candidates").select(F.col("isbn").alias("request_id"), F.col("title").alias("stem"), F.col("id").alias("expected")).distinct()
    return W.round_trips(r, table(spark, d, "books").select(F.col("book_id").alias("result_file"), F.col("isbn").alias("request_id"), F.col("title").alias("stem")))


STAGES = [("fetch", 0, 1.0, 0), ("parse", 0, 1.0, 0), ("build", 0, 0.5, 0), ("report", 0, 0.0, 0), ("audit", 2, 0.0, 0), ("mail", 0, 0.0, 1), ("close", 0, 1.0, 0)]
NEEDS = [("parse", "fetch"), ("build", "parse"), ("report", "build"), ("close", "report"), ("mail", "parse"), ("audit", "gone")]
_OWN = "CASE WHEN errors > 0 THEN 'error' WHEN ratio >= 1 THEN 'done' WHEN open_requests > 0 THEN 'waiting' WHEN ratio > 0 THEN 'in_progress' ELSE 'todo' END"


@query(f"""WITH RECURSIVE s(stage, errors, ratio, open_requests) AS (VALUES {sql_values(STAGES)}), n(stage, needs) AS (VALUES {sql_values(NEEDS)}), o AS (SELECT stage, {_OWN} own FROM s), up AS (SELECT stage, needs FROM n UNION SELECT up.stage, n.needs FROM up JOIN n ON n.stage = up.needs),
h AS (SELECT DISTINCT up.stage FROM up LEFT JOIN o ON o.stage = up.needs WHERE coalesce(own, 'missing') <> 'done') SELECT o.stage, CASE WHEN own = 'error' THEN 'error' WHEN h.stage IS NOT NULL THEN 'blocked' ELSE own END status FROM o LEFT JOIN h USING (stage)""")
def stage_status(spark: SparkSession, d: str) -> DataFrame:
    """Where each stage stands."""
    return W.stage_status(values(spark, STAGES, "stage string, errors int, ratio double, open_requests int"), values(spark, NEEDS, "stage string, needs string"))


@query(f"""WITH i AS ({B.ORACLES['identity_pairs_v2']}), r AS (SELECT DISTINCT v.legallib_book_id, b.canonical_bib_id, v.bucket FROM resolver v JOIN canonical_bib b USING (canonical_title)) SELECT DISTINCT legallib_book_id, canonical_bib_id, bucket, CASE WHEN bucket = 'auto_accept' THEN 'auto_accept_false_positive' ELSE 'defer_new_recall_miss' END why FROM r JOIN i USING (legallib_book_id, canonical_bib_id) WHERE (bucket = 'auto_accept' AND starts_with(status, 'suspected')) OR (bucket = 'defer_new' AND starts_with(status, 'same'))""")
def resend_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Earlier decisions worth another look."""
    r = table(spark, d, "resolver").join(table(spark, d, "canonical_bib").select("canonical_bib_id", "canonical_title"), "canonical_title").select("legallib_book_id", "canonical_bib_id", "bucket").distinct()
    return W.resend_candidates(r.join(B.identity_pairs_v2(spark, d), ["legallib_book_id", "canonical_bib_id"]), "status", "bucket").select("legallib_book_id", "canonical_bib_id", "bucket", "why").distinct()


@query("""WITH x AS (SELECT DISTINCT isbn item, source fam, ingested_at, publisher v, canonical_bib_id obs, CASE source WHEN 'ndl' THEN 1 WHEN 'publisher' THEN 2 ELSE 3 END pr FROM canonical_bib WHERE isbn IS NOT NULL AND publisher IS NOT NULL), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item, fam ORDER BY ingested_at DESC, pr DESC, v DESC, obs DESC) k FROM x) WHERE k = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY pr, ingested_at DESC, v) n FROM l), a AS (SELECT item, max(v) FILTER (WHERE n = 1) adopted, count(DISTINCT fam) families, count(DISTINCT v) vs FROM b GROUP BY 1)
SELECT item, adopted, CASE WHEN families = 1 THEN 'single_authority' WHEN vs = 1 THEN 'corroborated' ELSE 'disputed' END status, families, (SELECT string_agg(obs, ',' ORDER BY obs) FROM l WHERE l.item = a.item AND l.v = a.adopted) backing FROM a""")
def adopted_publishers(spark: SparkSession, d: str) -> DataFrame:
    """The publisher that each isbn is given, and by which records."""
    rank = F.when(F.col("source") == "ndl", 1).when(F.col("source") == "publisher", 2).otherwise(3)
    x = table(spark, d, "canonical_bib").where("isbn is not null and publisher is not null").select(F.col("isbn").alias("item"), F.col("source").alias("fam"), F.col("ingested_at").alias("at"), F.col("publisher").alias("v"), F.col("canonical_bib_id").alias("obs"), rank.alias("pr")).distinct()
    out = W.adopt_observations(x, ["item"], value="v", family="fam", priority="pr", at="at", obs="obs")
    return out.select("item", "adopted", "status", "families", F.array_join("contributor_obs", ",").alias("backing"))


@query(f"""WITH p AS (SELECT DISTINCT v.legallib_book_id, v.canonical_title, v.bucket, {Q.toc_title_key('v.legallib_title')} = {Q.toc_title_key('v.canonical_title')} truth FROM resolver v WHERE canonical_title IS NOT NULL), c AS (SELECT count_if(bucket = 'auto_accept' AND truth)::BIGINT tp, count_if(bucket = 'auto_accept' AND NOT truth)::BIGINT fp, count_if(bucket <> 'auto_accept' AND truth)::BIGINT fn, count_if(bucket <> 'auto_accept' AND NOT truth)::BIGINT tn FROM p)
SELECT *, round(tp / nullif(tp + fp, 0), 4) AS precision, round(tp / nullif(tp + fn, 0), 4) AS recall FROM c""")
def decision_metrics(spark: SparkSession, d: str) -> DataFrame:
    """How acceptance agrees with equal titles."""
    k = lambda c: X.toc_title_key(F.col(c))
    p = table(spark, d, "resolver").where("canonical_title is not null").select("legallib_book_id", "canonical_title", "bucket", (k("legallib_title") == k("canonical_title")).alias("truth")).distinct()
    return W.confusion(p, F.col("bucket") == "auto_accept", F.col("truth"))


@query(f"""WITH {O.RUNS_SQL}, t AS (SELECT DISTINCT s, id, title FROM rec), n AS (SELECT max(s) m FROM ro), a AS (SELECT s + 1 AS s, id, title FROM t, n WHERE s < m), b AS (SELECT * FROM t WHERE s > 1)
SELECT *, 'stored' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'made' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def view_drift(spark: SparkSession, d: str) -> DataFrame:
    """Titles that a load run and the one before it do not share."""
    t = O._runs(spark, d).select("s", "id", "title").distinct()
    last = table(spark, d, "load_run").select("load_run_id").distinct().count()
    return W.drift(t.where(F.col("s") < last).withColumn("s", F.col("s") + 1), t.where("s > 1"))


_MOVES = "CASE event_type WHEN 'click' THEN 'claim' WHEN 'purchase' THEN 'complete' WHEN 'error' THEN 'block' WHEN 'signup' THEN 'release' END"


@query(f"""WITH m AS (SELECT user_id AS task, ts, event_id, {_MOVES} AS move FROM events WHERE event_type <> 'view'), s AS (SELECT task, row_number() OVER w n, move, CASE move WHEN 'claim' THEN 'doing' WHEN 'complete' THEN 'done' WHEN 'block' THEN 'blocked' WHEN 'release' THEN 'inbox' END state, coalesce(lag(move) OVER w, 'release') b FROM m WINDOW w AS (PARTITION BY task ORDER BY ts, event_id))
SELECT task, n::INT n, move, state, (b || '>' || move) IN ('release>claim', 'claim>complete', 'claim>block', 'block>claim', 'claim>release') ok FROM s""")
def task_moves(spark: SparkSession, d: str) -> DataFrame:
    """Which moves the rules allow, events standing for moves of a user's task."""
    m = table(spark, d, "events").where("event_type <> 'view'").select(F.col("user_id").alias("task"), "ts", "event_id", F.expr(_MOVES).alias("move"))
    return W.task_states(m, "task", ["ts", "event_id"])


@query("""WITH n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY legallib_book_id ORDER BY decided_at DESC, bucket, coalesce(canonical_title, '')) k FROM resolver) WHERE k = 1) SELECT legallib_book_id, CASE WHEN bucket = 'auto_accept' AND canonical_title IS NOT NULL THEN 'candidate' WHEN bucket = 'human_review' THEN 'ambiguity' ELSE 'exclude' END lane FROM n WHERE legallib_book_id NOT IN (SELECT legallib_book_id FROM resolver GROUP BY 1 HAVING count(*) > 3)""")
def lane_routing(spark: SparkSession, d: str) -> DataFrame:
    """The lane of each new decision; records seen more than three times are there already."""
    r = table(spark, d, "resolver")
    seen = r.groupBy("legallib_book_id").count().where("count > 3")
    new = W.staged_append(r, seen, "legallib_book_id", [F.desc("decided_at"), "bucket", F.coalesce("canonical_title", F.lit(""))])
    lane = F.when((F.col("bucket") == "auto_accept") & F.col("canonical_title").isNotNull(), "candidate").when(F.col("bucket") == "human_review", "ambiguity").otherwise("exclude")
    return new.select("legallib_book_id", lane.alias("lane"))


FULL_REF = "([一-龥]{1,10}(?:法|通則|約款))([0-9]+)条(?:の([0-9]+))?(?:第?([0-9]+)項)?(?:第?([0-9]+)号)?"
_G = lambda k: f"regexp_extract(ref, '{FULL_REF}', {k})"


@query(f"""WITH r AS (SELECT unnest(regexp_extract_all(text, '{FULL_REF}')) ref FROM documents), p AS (SELECT {_G(1)} law, 'art:' || {_G(2)} || CASE WHEN {_G(3)} <> '' THEN '-' || {_G(3)} ELSE '' END || CASE WHEN {_G(4)} <> '' THEN ':para:' || {_G(4)} ELSE '' END || CASE WHEN {_G(5)} <> '' THEN ':item:' || {_G(5)} ELSE '' END path FROM r) SELECT law, path, split_part(split_part(path, ':para:', 1), ':item:', 1) root, count(*) n FROM p GROUP BY 1, 2, 3""")
def article_paths(spark: SparkSession, d: str) -> DataFrame:
    """Cited provisions as paths of article, paragraph and item."""
    refs = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(FULL_REF), F.lit(0))).alias("ref"))
    g = lambda k: F.regexp_extract("ref", FULL_REF, k)
    opt = lambda mark, k: F.when(g(k) != "", F.concat(F.lit(mark), g(k))).otherwise("")
    path = F.concat(F.lit("art:"), g(2), opt("-", 3), opt(":para:", 4), opt(":item:", 5))
    return refs.select(g(1).alias("law"), path.alias("path")).groupBy("law", "path", X.article_root(F.col("path")).alias("root")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH t AS (SELECT DISTINCT canonical_bib_id, canonical_title FROM canonical_bib), p AS (SELECT canonical_bib_id, regexp_extract(canonical_title, '第([0-9]+)版', 1) ed, regexp_extract(canonical_title, '(上|中|下)巻', 1) vol, regexp_matches(canonical_title, '改訂|新訂|増補|補訂|全訂') rev FROM t)
SELECT canonical_bib_id, nullif(ed, '')::INT AS edition_no, nullif(vol, '') volume, CASE WHEN ed <> '' OR rev THEN true ELSE false END has_marker, CASE WHEN rev AND ed = '' THEN true ELSE false END unknown_marker FROM p""")
def edition_markers(spark: SparkSession, d: str) -> DataFrame:
    """Edition and volume that titles tell."""
    t = table(spark, d, "canonical_bib").select("canonical_bib_id", "canonical_title").distinct()
    ed, vol, rev = F.regexp_extract("canonical_title", "第([0-9]+)版", 1), F.regexp_extract("canonical_title", "(上|中|下)巻", 1), F.col("canonical_title").rlike("改訂|新訂|増補|補訂|全訂")
    return t.select("canonical_bib_id", F.nullif(ed, F.lit("")).try_cast("int").alias("edition_no"), F.nullif(vol, F.lit("")).alias("volume"), ((ed != "") | rev).alias("has_marker"), (rev & (ed == "")).alias("unknown_marker"))


@query("""WITH o AS (SELECT c_mktsegment seg, c_custkey, count(o_orderkey) n, min(o_orderdate) a, max(o_orderdate) b FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) SELECT seg, count(*) customers, round(avg((n > 0)::INT), 4) conversion, median(date_diff('day', a::DATE, b::DATE)) FILTER (WHERE n > 1) median_days FROM o GROUP BY 1""")
def segment_funnel(spark: SparkSession, d: str) -> DataFrame:
    """Conversion and span of orders by segment."""
    o = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(F.col("c_mktsegment").alias("seg"), "c_custkey").agg(F.count("o_orderkey").alias("n"), F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return o.groupBy("seg").agg(F.count(F.lit(1)).alias("customers"), F.round(F.avg((F.col("n") > 0).cast("int")), 4).alias("conversion"), F.median(F.when(F.col("n") > 1, F.datediff("b", "a"))).alias("median_days"))


@query(f"WITH x AS ({O.ORACLES['health_score']}) SELECT CASE WHEN health < 50 THEN '0-49' WHEN health < 80 THEN '50-79' WHEN health < 100 THEN '80-99' ELSE '100' END bucket, count(*) n, min(health) lowest FROM x GROUP BY 1")
def health_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Books by health."""
    h = F.col("health")
    return O.health_score(spark, d).groupBy(F.when(h < 50, "0-49").when(h < 80, "50-79").when(h < 100, "80-99").otherwise("100").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("health").alias("lowest"))


@query(f"WITH x AS ({B.ORACLES['risk_level']}) SELECT risk, count(*) n, sum(unresolved)::BIGINT unresolved FROM x GROUP BY 1")
def risk_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Books by risk."""
    return B.risk_level(spark, d).groupBy("risk").agg(F.count(F.lit(1)).alias("n"), F.sum("unresolved").alias("unresolved"))


@query(f"WITH x AS ({B.ORACLES['base_source']}) SELECT base_source, count(*) n FROM x GROUP BY 1")
def base_source_rollup(spark: SparkSession, d: str) -> DataFrame:
    """How often each source is the base."""
    return B.base_source(spark, d).groupBy("base_source").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT book_id, toc_source, count(DISTINCT toc_node_id) n FROM toc_nodes GROUP BY 1, 2) SELECT toc_source, CASE WHEN n = 0 THEN 'empty' WHEN n <= 10 THEN '1-10' WHEN n <= 50 THEN '11-50' ELSE '51+' END bucket, count(*) n FROM s GROUP BY 1, 2""")
def size_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Outlines by source and size."""
    s = table(spark, d, "toc_nodes").groupBy("book_id", "toc_source").agg(F.count_distinct("toc_node_id").alias("k"))
    return s.groupBy("toc_source", X.size_bucket(F.col("k")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


TAXONOMY = [("isbn_absent", "L1", "P1", "enrich"), ("publisher_absent", "L1", "P2", "enrich"), ("toc_absent", "L2", "P1", "collect")]


@query(f"""WITH t(defect, family, severity, route) AS (VALUES {sql_values(TAXONOMY)}), r AS ({O.ORACLES['regression_diff']}) SELECT coalesce(family, 'unknown') family, coalesce(route, 'review') route, change, count(*) n FROM r LEFT JOIN t USING (defect) GROUP BY 1, 2, 3""")
def defect_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Changes of defects by family and route; unknown ones go to review."""
    t = F.broadcast(values(spark, TAXONOMY, "defect string, family string, severity string, route string"))
    return O.regression_diff(spark, d).join(t, "defect", "left").groupBy(F.coalesce("family", F.lit("unknown")).alias("family"), F.coalesce("route", F.lit("review")).alias("route"), "change").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT b.book_id FROM books b WHERE EXISTS (SELECT 1 FROM toc_nodes n WHERE n.book_id = b.book_id) AND NOT EXISTS (SELECT 1 FROM books x WHERE x.book_id = b.book_id AND x.has_toc)")
def exists_gate(spark: SparkSession, d: str) -> DataFrame:
    """Books that have nodes and are not known to have an outline."""
    b = table(spark, d, "books")
    return b.select("book_id").distinct().join(table(spark, d, "toc_nodes"), "book_id", "left_semi").join(b.where("has_toc"), "book_id", "left_anti")


@query("""SELECT count_if(print_page IS NOT NULL AND page_start IS NOT NULL)::BIGINT AS both, count_if(print_page IS NULL AND page_start IS NOT NULL)::BIGINT start_only, count_if(print_page IS NOT NULL AND page_start IS NULL)::BIGINT print_only, count_if(print_page IS NULL AND page_start IS NULL)::BIGINT neither, toc_source FROM toc_nodes GROUP BY toc_source""")
def page_basis_profile(spark: SparkSession, d: str) -> DataFrame:
    """Which pages the nodes of each source carry."""
    a, b = F.col("print_page").isNotNull(), F.col("page_start").isNotNull()
    return table(spark, d, "toc_nodes").groupBy("toc_source").agg(F.count_if(a & b).alias("both"), F.count_if(~a & b).alias("start_only"), F.count_if(a & ~b).alias("print_only"), F.count_if(~a & ~b).alias("neither"))


@query("""SELECT event_type, extract('hour' FROM ts)::INT AS hour, count(*) n, min(value) lo, median(value) mid, max(value) hi FROM events GROUP BY 1, 2""")
def event_profile(spark: SparkSession, d: str) -> DataFrame:
    """Spread of values by type and hour."""
    return table(spark, d, "events").groupBy("event_type", F.hour(F.col("ts").cast("timestamp")).alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.median("value").alias("mid"), F.max("value").alias("hi"))
