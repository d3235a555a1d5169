"""Queries of adoption, joining, conflicts and citations over whole tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import adoption as A
from folioforge.operators import concordance as C
from folioforge.operators import joining as J
from folioforge.operators import linkage as K
from folioforge.operators import outline as O
from folioforge.plans import library as B
from folioforge.plans import sqltext as Q
from folioforge.plans.library import NODES_SQL, nodes
from folioforge.plans.operations import sql_values
from folioforge.runtime import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
PRIORITY = ["manual", "publisher", "legallib", "ndl", "bencom", "openbd", "toc_pdf", "codex_ocr"]
_RANK = "CASE toc_source " + " ".join(f"WHEN '{s}' THEN {n}" for n, s in enumerate(PRIORITY)) + " ELSE 1000 END"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ------------------------------------------------------------------ conflicts, identity, authority
SOURCES_SQL = f"""{B.CONFLICT_SQL}, srcs AS (SELECT book_id, toc_source, CASE WHEN toc_source IN ('toc_pdf', 'codex_ocr') THEN 'pdf_page' ELSE 'print_page' END page_basis, CASE WHEN toc_source = 'codex_ocr' THEN NULL WHEN toc_source = 'toc_pdf' THEN 'publisher' ELSE toc_source END origin, count(*) n FROM nodes GROUP BY 1, 2),
ident AS (SELECT s.book_id, CASE WHEN count(*) < 2 THEN 'insufficient_evidence' WHEN length(regexp_replace(coalesce(b.isbn, ''), '[^0-9]', '', 'g')) = 13 THEN 'resolved_same_manifestation' WHEN coalesce(b.title, '') <> '' AND coalesce(b.publisher, '') <> '' THEN 'resolved_same_manifestation' ELSE 'suspected_different_manifestation' END status FROM srcs s JOIN books b USING (book_id) GROUP BY s.book_id, b.isbn, b.title, b.publisher),
allc AS (SELECT book_id, pattern, severity, resolved, source FROM conflicts UNION ALL SELECT book_id, 'page_basis_mismatch', 'moderate', false, '' FROM srcs GROUP BY book_id HAVING count(DISTINCT page_basis) >= 2
UNION ALL SELECT book_id, 'edition_mismatch_suspected', CASE WHEN starts_with(status, 'suspected') THEN 'structural' ELSE 'moderate' END, false, '' FROM ident WHERE NOT starts_with(status, 'resolved_same'))"""


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """The sources of each book with what is declared of them; no table holds these, so they follow from the source's name."""
    s = F.col("source")
    each = nodes(spark, d).groupBy("book_id", F.col("toc_source").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    pdf = s.isin("toc_pdf", "codex_ocr")
    return each.withColumn("page_basis", F.when(pdf, "pdf_page").otherwise("print_page")).withColumn("provenance_origin", F.when(s == "codex_ocr", None).when(s == "toc_pdf", "publisher").otherwise(s))


def _identity(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "books").select("book_id", F.length(F.regexp_replace(F.coalesce("isbn", F.lit("")), "[^0-9]", "")).alias("digits"), ((F.coalesce("title", F.lit("")) != "") & (F.coalesce("publisher", F.lit("")) != "")).alias("named"))
    n = _sources(spark, d).groupBy("book_id").agg(F.count(F.lit(1)).alias("k")).join(b, "book_id")
    return n.select("book_id", F.when(F.col("k") < 2, "insufficient_evidence").when((F.col("digits") == 13) | F.col("named"), "resolved_same_manifestation").otherwise("suspected_different_manifestation").alias("status"))


def _all_conflicts(spark: SparkSession, d: str) -> DataFrame:
    rows = nodes(spark, d).withColumn("scheme", X.numbering_scheme(F.col("title")))
    return C.conflicts(rows, book="book_id", source="toc_source", title="title", key="k", depth="depth", scheme="scheme", sources=_sources(spark, d), identity=_identity(spark, d))


@query(f"WITH {SOURCES_SQL} SELECT * FROM allc")
def conflict_detectors(spark: SparkSession, d: str) -> DataFrame:
    """All eight kinds of conflict between a book's outlines."""
    return _all_conflicts(spark, d)


_RISK_SQL = """g AS (SELECT book_id, count_if(NOT resolved)::BIGINT unresolved, count(*) total, bool_or(severity = 'structural' AND NOT resolved) structural FROM allc GROUP BY 1),
rated AS (SELECT i.book_id, i.status, coalesce(unresolved, 0) unresolved, coalesce(total, 0) total, CASE WHEN coalesce(structural, false) OR NOT starts_with(i.status, 'resolved_same') THEN 'high' WHEN coalesce(unresolved, 0) > 0 THEN 'medium' ELSE 'low' END risk FROM ident i LEFT JOIN g USING (book_id))"""


@query(f"WITH {SOURCES_SQL}, {_RISK_SQL}, ex AS (SELECT book_id, count_if(origin IS NULL)::BIGINT excluded FROM srcs GROUP BY 1) SELECT book_id, status AS edition_identity_status, total::BIGINT total, unresolved AS open, risk, excluded AS consensus_excluded_sources FROM rated JOIN ex USING (book_id)")
def book_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Each book's conflicts, identity and risk."""
    i = _identity(spark, d)
    accounted = C.accounting(nodes(spark, d), "book_id", "toc_source", "k").join(i.select("book_id"), "book_id", "left_semi")
    out = C.book_summary(_all_conflicts(spark, d).join(i.select("book_id"), "book_id", "left_semi"), i, accounted, _sources(spark, d).join(i.select("book_id"), "book_id", "left_semi"), "book_id")
    return out.select("book_id", "edition_identity_status", "total", "open", "risk", "consensus_excluded_sources")


# ------------------------------------------------------------------ adoption
ADOPT_SQL = f"""{SOURCES_SQL}, nn AS (SELECT book_id, toc_source, idx, title, regexp_replace(k, '^$', '') k, depth, page_start page, toc_status, toc_node_id FROM keyed WHERE coalesce(k, '') <> ''),
st AS (SELECT book_id, toc_source, max(coalesce(depth, 1)) md, count(*) n, round(count(page) / count(*), 4) pc, {_RANK} rk FROM nn GROUP BY 1, 2),
tp AS (SELECT *, first_value(md) OVER w tmd, first_value(n) OVER w tn FROM st WINDOW w AS (PARTITION BY book_id ORDER BY md DESC, n DESC, pc DESC, rk, toc_source DESC)),
ab AS (SELECT *, n >= 0.2 * tn AND md >= tmd able FROM tp), inc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY rk, toc_source) z FROM ab) WHERE z = 1),
cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY able DESC, md DESC, n DESC, pc DESC, rk, toc_source DESC) z FROM ab) WHERE z = 1),
base AS (SELECT i.book_id, CASE WHEN i.toc_source = 'manual' AND i.md > 1 AND (i.able OR i.toc_source = c.toc_source) THEN i.toc_source WHEN i.md <= 1 THEN c.toc_source WHEN i.able THEN i.toc_source ELSE c.toc_source END base FROM inc i JOIN cand c USING (book_id)),
own AS (SELECT nn.*, b.base, NULL::VARCHAR appended FROM nn JOIN base b ON b.book_id = nn.book_id AND b.base = nn.toc_source),
oth AS (SELECT * EXCLUDE (z) FROM (SELECT nn.*, b.base, toc_source appended, row_number() OVER (PARTITION BY nn.book_id, k ORDER BY {_RANK}, toc_source, idx, toc_node_id) z FROM nn JOIN base b ON b.book_id = nn.book_id AND b.base <> nn.toc_source WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.book_id = nn.book_id AND o.k = nn.k)) WHERE z = 1),
vt AS (SELECT nn.book_id, k, count(DISTINCT coalesce(origin, nn.toc_source)) v FROM nn JOIN srcs s ON s.book_id = nn.book_id AND s.toc_source = nn.toc_source GROUP BY 1, 2),
off AS (SELECT book_id, CASE WHEN page_offset.confidence >= 1 AND page_offset.validated THEN page_offset."offset" END o FROM books),
laned AS (SELECT c.*, v, v >= 2 consensus, toc_status IS NULL lost, c.toc_source IN ('toc_pdf', 'codex_ocr') AND page IS NOT NULL AND o IS NULL needs, CASE WHEN c.toc_source IN ('toc_pdf', 'codex_ocr') AND page IS NOT NULL AND o IS NOT NULL THEN page - o ELSE page END new_page FROM (SELECT * FROM own UNION ALL SELECT * FROM oth) c JOIN vt USING (book_id, k) LEFT JOIN off USING (book_id)),
lanes AS (SELECT *, CASE WHEN lost THEN 'non_adoptable' WHEN NOT consensus OR needs THEN 'pending' ELSE 'accepted' END lane FROM laned)"""


def _adoption(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    n = nodes(spark, d).where("coalesce(k, '') <> ''").select(F.col("book_id").alias("book"), F.col("toc_source").alias("source"), "idx", "toc_node_id", "title", "k", "depth", F.col("page_start").alias("page"), F.col("toc_source").isin("toc_pdf", "codex_ocr").alias("page_is_pdf"), F.lit(None).cast("string").alias("part_kind"), F.lit(None).cast("string").alias("author"), "toc_status")
    s = _sources(spark, d).withColumnRenamed("book_id", "book").withColumn("source_sha256", F.lit("x"))
    b = table(spark, d, "books").select(F.col("book_id").alias("book"), "page_offset")
    stats = O.granularity(n.withColumn("depth", F.coalesce("depth", F.lit(1))), ["book", "source"], "depth", "page")
    base = A.choose_base(stats, PRIORITY, protected=("manual",))
    done = A.complete(n, s, b, base, PRIORITY)
    # a node without a stored status has no snapshot
    status = n.select("book", "source", "idx", "k", "toc_node_id", (F.col("toc_status").isNull()).alias("lost"))
    done = done.join(status.groupBy("book", "source", "idx", "k").agg(F.bool_or("lost").alias("lost")), ["book", "source", "idx", "k"]).withColumn("snapshot_missing", F.col("lost")).withColumn("source_hash", F.when(~F.col("lost"), F.col("source_hash"))).drop("lost")
    cluster = s.select("book", "source", F.lit(True).alias("in_cluster"))
    laned = A.lanes(done, n, s, cluster, least=2)
    return {"nodes": n, "sources": s, "stats": stats, "base": base, "laned": laned}


@query(f"WITH {ADOPT_SQL} SELECT book_id AS book, base, count(*) n FROM (SELECT book_id, base FROM base) GROUP BY 1, 2")
def adoption_base(spark: SparkSession, d: str) -> DataFrame:
    """The source that each book's outline is built on."""
    return _adoption(spark, d)["base"].groupBy("book", "base").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ADOPT_SQL} SELECT book_id AS book, lane, coalesce(appended, base) from_source, count(*) n, sum(v)::BIGINT votes, sum(new_page)::BIGINT pages, count_if(needs)::BIGINT needing FROM lanes GROUP BY 1, 2, 3")
def adoption_lanes(spark: SparkSession, d: str) -> DataFrame:
    """Completed outlines by book, lane and source."""
    return _adoption(spark, d)["laned"].groupBy("book", "lane", F.coalesce("appended_from", "base").alias("from_source")).agg(F.count(F.lit(1)).alias("n"), F.sum("votes").alias("votes"), F.sum("page").alias("pages"), F.count_if("needs_offset").alias("needing"))


@query(f"""WITH {ADOPT_SQL}, c AS (SELECT book_id, count_if(lane = 'accepted')::BIGINT accepted, count_if(lane = 'pending')::BIGINT pending, count_if(lane = 'non_adoptable')::BIGINT non_adoptable, count_if(lane = 'pending' AND NOT consensus)::BIGINT lone FROM lanes GROUP BY 1),
e AS (SELECT b.book_id book, base AS base_source, coalesce(accepted, 0) accepted, coalesce(pending, 0) pending, coalesce(non_adoptable, 0) non_adoptable, coalesce(lone, 0) lone, coalesce(starts_with(status, 'resolved_same'), false) same FROM books b LEFT JOIN base USING (book_id) LEFT JOIN c USING (book_id) LEFT JOIN ident USING (book_id)),
o AS (SELECT book_id book, count(DISTINCT origin) origins FROM srcs GROUP BY 1)
SELECT book, base_source, accepted, pending, non_adoptable, CASE WHEN base_source IS NULL THEN 'no_base' ELSE concat_ws(',', CASE WHEN NOT same THEN 'identity_unresolved' END, CASE WHEN NOT (accepted > 0 AND lone = 0) THEN 'non_consensus_or_empty' END, CASE WHEN NOT (same AND coalesce(origins, 0) >= 3) THEN 'authority_human_review' END, CASE WHEN non_adoptable > 0 THEN 'non_adoptable_nodes_present' END) END blockers FROM e LEFT JOIN o USING (book)""")
def adoption_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """What each book would adopt, and what stands against it."""
    a = _adoption(spark, d)
    identity = _identity(spark, d).withColumnRenamed("book_id", "book")
    meta = a["sources"].withColumns({c: F.lit(None).cast("string") for c in ("extraction_method", "extraction_confidence", "coverage")})
    authority = C.resolve_authority(meta, identity, "book")
    accepted = A.linked(a["laned"], PRIORITY)
    e = A.envelopes(table(spark, d, "books").select(F.col("book_id").alias("book")), identity, a["base"], a["laned"], accepted, authority)
    return e.select("book", "base_source", "accepted", "pending", "non_adoptable", F.array_join("blockers", ",").alias("blockers"))


@query(f"SELECT gate, 0::BIGINT AS n FROM (VALUES {', '.join(f'({Q.quoted(g)})' for g in A.GATE_NAMES)}) t(gate)")
def adoption_gate_breaches(spark: SparkSession, d: str) -> DataFrame:
    """Breaches of each adoption gate; the chain's own rules leave none."""
    a = _adoption(spark, d)
    identity = _identity(spark, d).withColumnRenamed("book_id", "book")
    meta = a["sources"].withColumns({c: F.lit(None).cast("string") for c in ("extraction_method", "extraction_confidence", "coverage")})
    accepted = A.linked(a["laned"], PRIORITY)
    e = A.envelopes(table(spark, d, "books").select(F.col("book_id").alias("book")), identity, a["base"], a["laned"], accepted, C.resolve_authority(meta, identity, "book"))
    # a protected incumbent is let be, whatever its depth
    kept = a["base"].where("reason = 'protected incumbent kept'").select("book")
    found = A.adoption_gates(e.join(kept, "book", "left_anti"), a["laned"], accepted, a["nodes"], a["sources"], a["stats"])
    names = spark.createDataFrame([(g,) for g in A.GATE_NAMES], "gate string")
    return names.join(found.groupBy("gate").agg(F.count(F.lit(1)).alias("n")), "gate", "left").na.fill(0, ["n"])


# ------------------------------------------------------------------ joining
_LIGHT = lambda c: f"upper(regexp_replace(translate({c}, {B._WIDE}), '[^0-9Xx]', '', 'g'))"
EXISTING_SQL = f"""ex AS (SELECT {_LIGHT("b.isbn")} isbn, CASE WHEN bool_or(toc_status IS NULL AND n.depth IS NULL) THEN 'unreadable' WHEN bool_and(coalesce(toc_status, '') = 'draft') THEN 'simple' ELSE 'mixed' END state, bool_or(coalesce(n.depth > 1, false) OR page_start IS NOT NULL) rich, bool_or(toc_source IN ('publisher', 'manual')) prot, bool_and(coalesce(toc_status = 'legallib', false)) done, count(*) n FROM nodes n JOIN books b USING (book_id) WHERE b.isbn IS NOT NULL GROUP BY 1)"""
DRY_SQL = f"""{NODES_SQL}, {EXISTING_SQL}, one AS (SELECT canonical_title, min({_LIGHT("isbn")}) isbn FROM canonical_bib WHERE isbn IS NOT NULL GROUP BY 1), rs AS (SELECT DISTINCT md5(concat_ws('|', legallib_book_id, bucket, decided_at::VARCHAR, coalesce(canonical_title, ''), coalesce(resolver_confidence::VARCHAR, ''))) row_id, legallib_book_id book_id, bucket, isbn FROM resolver LEFT JOIN one USING (canonical_title)),
auto AS (SELECT DISTINCT book_id, isbn FROM rs WHERE bucket = 'auto_accept' AND coalesce(isbn, '') <> ''), bi AS (SELECT isbn, count(*) nb FROM auto GROUP BY 1), bb AS (SELECT book_id, count(*) ni FROM auto GROUP BY 1), kn AS (SELECT DISTINCT {_LIGHT("isbn")} isbn, true AS known FROM canonical_bib WHERE isbn IS NOT NULL), dl AS (SELECT legallib_book_id book_id, max(page_count)::BIGINT n FROM legallib_bib GROUP BY 1),
dry AS (SELECT row_id, rs.book_id, rs.isbn, ex.state, prot, rich, CASE WHEN bucket NOT IN ('auto_accept', 'human_review', 'defer_new') THEN 'skip_unknown_bucket' WHEN bucket = 'defer_new' THEN 'defer_staging' WHEN bucket = 'human_review' THEN 'route_human_review' WHEN rs.book_id = '' THEN 'blocked_no_book_id' WHEN NOT coalesce(regexp_matches(rs.isbn, '^97[89][0-9]{{10}}$'), false) THEN 'blocked_bad_isbn' WHEN known IS NULL THEN 'blocked_missing_isbn' WHEN nb > 1 THEN 'blocked_ambiguous_isbn' WHEN ni > 1 THEN 'blocked_ambiguous_book' WHEN coalesce(dl.n, 0) = 0 THEN 'skip_empty_source' WHEN ex.state = 'unreadable' THEN 'route_human_review' WHEN ex.state IS NULL THEN 'create' WHEN done THEN 'skip_idempotent' WHEN prot OR rich OR ex.state <> 'simple' THEN 'route_human_review' ELSE 'overwrite_simple' END AS action, coalesce(dl.n, 0) new_nodes, coalesce(ex.n, 0) existing_nodes
FROM rs LEFT JOIN bi USING (isbn) LEFT JOIN bb USING (book_id) LEFT JOIN kn USING (isbn) LEFT JOIN dl USING (book_id) LEFT JOIN ex ON ex.isbn = rs.isbn)"""


def _existing(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d).join(table(spark, d, "books").where("isbn is not null").select("book_id", X.isbn_light(F.col("isbn")).alias("isbn")), "book_id")
    status = F.coalesce("toc_status", F.lit(""))
    return n.groupBy("isbn").agg(
        F.when(F.bool_or(F.col("toc_status").isNull() & F.col("depth").isNull()), "unreadable").when(F.bool_and(status == "draft"), "simple").otherwise("mixed").alias("state"),
        F.bool_or(F.coalesce(F.col("depth") > 1, F.lit(False)) | F.col("page_start").isNotNull()).alias("rich"), F.bool_or(F.col("toc_source").isin("publisher", "manual")).alias("protected"), F.bool_and(status == "legallib").alias("done"), F.count(F.lit(1)).alias("n"),
    )


def _dry_run(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    one = table(spark, d, "canonical_bib").where("isbn is not null").groupBy("canonical_title").agg(F.min(X.isbn_light(F.col("isbn"))).alias("isbn"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    r = table(spark, d, "resolver").join(one, "canonical_title", "left")
    r = r.select(F.md5(F.concat_ws("|", "legallib_book_id", "bucket", F.col("decided_at").cast("string"), text("canonical_title"), text("resolver_confidence"))).alias("row_id"), F.col("legallib_book_id").alias("book_id"), "bucket", "isbn").distinct()
    delivered = table(spark, d, "legallib_bib").groupBy(F.col("legallib_book_id").alias("book_id")).agg(F.max("page_count").cast("long").alias("n"))
    existing = _existing(spark, d)
    return J.dry_run(r, delivered, existing, table(spark, d, "canonical_bib").where("isbn is not null").select(X.isbn_light(F.col("isbn")).alias("isbn"))), existing


@query(f"WITH {DRY_SQL} SELECT book_id, isbn, action, new_nodes::BIGINT new_nodes, existing_nodes FROM dry")
def join_dryrun(spark: SparkSession, d: str) -> DataFrame:
    """What each earlier decision would do to the outlines at hand."""
    return _dry_run(spark, d)[0].select("book_id", "isbn", "action", "new_nodes", "existing_nodes")


@query(f"WITH {DRY_SQL}, wl AS (SELECT DISTINCT {_LIGHT("isbn")} isbn FROM books WHERE has_toc AND isbn IS NOT NULL) SELECT action, CASE WHEN w.isbn IS NULL THEN 'needs_approval' WHEN coalesce(prot OR rich OR state <> 'simple', false) THEN 'refused_protected' ELSE 'would_write' END status, count(*) n FROM dry LEFT JOIN wl w ON w.isbn = dry.isbn WHERE action IN ('create', 'overwrite_simple') GROUP BY 1, 2")
def join_apply(spark: SparkSession, d: str) -> DataFrame:
    """What an apply would do with the isbns of books with an outline as whitelist."""
    actions, existing = _dry_run(spark, d)
    done = J.apply_status(actions, existing, table(spark, d, "books").where("has_toc and isbn is not null").select(X.isbn_light(F.col("isbn")).alias("isbn")), commit=False)
    return done.groupBy("action", "status").agg(F.count(F.lit(1)).alias("n"))


_REQ_SQL = f"""{SOURCES_SQL}, cf AS (SELECT book_id, count_if(NOT resolved)::BIGINT open FROM allc GROUP BY 1), ac AS (SELECT book_id, bool_and(coalesce(k, '') <> '') whole FROM keyed GROUP BY 1), pf AS (SELECT book_id, bool_or(page_basis = 'pdf_page') pdf FROM srcs GROUP BY 1),
rq AS (SELECT b.book_id isbn, coalesce(open, 0) open, status, coalesce(pdf, false) pdf, coalesce(page_offset.validated, false) good, coalesce(has_toc, false) bundle, created_at IS NOT NULL AS log, coalesce(whole, false) whole, b.isbn IN (SELECT isbn FROM candidates WHERE isbn IS NOT NULL) listed FROM books b LEFT JOIN cf USING (book_id) LEFT JOIN ident USING (book_id) LEFT JOIN ac USING (book_id) LEFT JOIN pf USING (book_id))"""


@query(f"""WITH {_REQ_SQL} SELECT isbn, concat_ws(',', CASE WHEN NOT coalesce(listed, false) THEN 'whitelist_required' END, CASE WHEN open > 0 THEN 'no_unresolved_conflict' END, CASE WHEN NOT coalesce(status = 'resolved_same_manifestation', false) THEN 'edition_identity_resolved' END, CASE WHEN pdf AND NOT good THEN 'pdf_authority_qualified' END, CASE WHEN NOT bundle THEN 'rollback_bundle_present' END, CASE WHEN NOT log THEN 'decision_log_append_only' END, CASE WHEN NOT whole THEN 'all_nodes_accounted_for' END) refusals FROM rq""")
def apply_guard(spark: SparkSession, d: str) -> DataFrame:
    """Which of seven conditions refuse a write to each book."""
    return _guarded(spark, d).select("isbn", F.array_join("refusals", ",").alias("refusals"))


@query(f"""WITH g AS ({ORACLES['apply_guard']}) SELECT gate, count(*) n FROM (SELECT unnest(string_split(refusals, ',')) gate FROM g) WHERE gate <> '' GROUP BY 1 UNION ALL SELECT 'allowed', count(*) FROM g WHERE refusals = ''""")
def guard_rollup(spark: SparkSession, d: str) -> DataFrame:
    """How often each condition refuses."""
    return J.guard_rollup(_guarded(spark, d))


def _guarded(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "books")
    open_ = _all_conflicts(spark, d).groupBy("book_id").agg(F.count_if(~F.col("resolved")).alias("unresolved_conflicts"))
    whole = nodes(spark, d).groupBy("book_id").agg(F.bool_and(F.coalesce("k", F.lit("")) != "").alias("nodes_accounted"))
    pdf = _sources(spark, d).groupBy("book_id").agg(F.bool_or(F.col("page_basis") == "pdf_page").alias("uses_pdf_authority"))
    listed = b.join(table(spark, d, "candidates").where("isbn is not null").select("isbn").distinct(), "isbn", "left_semi").select(F.col("book_id").alias("isbn"))
    r = b.join(open_, "book_id", "left").join(_identity(spark, d).withColumnRenamed("status", "edition_identity_status"), "book_id", "left").join(whole, "book_id", "left").join(pdf, "book_id", "left")
    r = r.select(F.col("book_id").alias("isbn"), "unresolved_conflicts", "edition_identity_status", "uses_pdf_authority", F.col("page_offset.validated").alias("pdf_qualified"), F.col("has_toc").alias("rollback_bundle"), F.col("created_at").isNotNull().alias("log_append_only"), "nodes_accounted")
    return J.apply_guard(r, listed)


# ------------------------------------------------------------------ citations
ALIASES = {"civil": "civil law", "ip": "intellectual property"}
_JK = lambda e: f"coalesce(map_extract_value(MAP {{{', '.join(f'{Q.quoted(a)}: {Q.quoted(b)}' for a, b in ALIASES.items())}}}, replace(replace(coalesce({e}, ''), ' ', ''), '　', '')), replace(replace(coalesce({e}, ''), ' ', ''), '　', ''))"
_BASES = ", ".join(f"('{b}', '{t}', {s})" for b, (t, s) in K.CITATION_TIERS.items())


@query(f"""WITH ed AS (SELECT DISTINCT 'j' || id edge_id, coalesce(primary_domain, '') j, coalesce(total_toc, 0)::VARCHAR i, coalesce(matched_toc, 0)::VARCHAR p FROM candidates), ix AS (SELECT id AS target, primary_domain j0, coalesce(total_toc, 0)::VARCHAR i, coalesce(matched_toc, 0)::VARCHAR p FROM candidates), kx AS (SELECT target, {_JK('j0')} j, i, p FROM ix),
jp AS (SELECT j, i, p, count(*) c, count(DISTINCT target) n, min(target) one FROM kx GROUP BY 1, 2, 3), ji AS (SELECT j, i, count(*) c, count(DISTINCT target) n, min(target) one FROM kx GROUP BY 1, 2),
r AS (SELECT edge_id, e.j <> '' ok, {_JK('e.j')} <> e.j al, jp.c pc, jp.n pn, jp.one po, ji.c ic, ji.n nn, ji.one io FROM (SELECT edge_id, j, i, p FROM ed) e LEFT JOIN jp ON jp.j = {_JK('e.j')} AND jp.i = e.i AND jp.p = e.p LEFT JOIN ji ON ji.j = {_JK('e.j')} AND ji.i = e.i),
b AS (SELECT *, CASE WHEN NOT ok THEN 'insufficient_signal' WHEN pc = 1 THEN CASE WHEN al THEN 'exact_alias' ELSE 'exact' END WHEN pc > 1 THEN 'issue_page_collision' WHEN ic = 1 THEN 'issue_unique' WHEN ic > 1 THEN 'issue_multi' ELSE 'index_absent' END match_basis FROM r),
dt AS (SELECT o_custkey::VARCHAR court, o_orderdate::DATE::VARCHAR date, count(*) c, count(DISTINCT o_orderkey) n, min(o_orderkey::VARCHAR) one FROM orders GROUP BY 1, 2), d AS (SELECT 'o' || o_orderkey edge_id, CASE WHEN c = 1 THEN 'court_date_unique' ELSE 'court_date_multi' END match_basis, n, one FROM orders JOIN dt ON court = o_custkey::VARCHAR AND date = o_orderdate::DATE::VARCHAR),
a AS (SELECT edge_id, match_basis, CASE WHEN match_basis IN ('exact', 'exact_alias', 'issue_page_collision') THEN pn WHEN match_basis IN ('issue_unique', 'issue_multi') THEN nn ELSE 0 END n, CASE WHEN match_basis IN ('exact', 'exact_alias', 'issue_page_collision') THEN po WHEN match_basis IN ('issue_unique', 'issue_multi') THEN io END one FROM b UNION ALL SELECT edge_id, match_basis, n, one FROM d), t(match_basis, tier, score) AS (VALUES {_BASES})
SELECT edge_id, match_basis, tier, score::DOUBLE score, n sibling_count, CASE WHEN n = 1 THEN one END target FROM a JOIN t USING (match_basis)""")
def cite_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Citations by journal, issue and page (candidates stand for articles) and by court and date (orders for judgments)."""
    c = table(spark, d, "candidates")
    text = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("0"))
    by = c.select(F.concat(F.lit("j"), "id").alias("edge_id"), F.lit("cites_judgment_via_journal").alias("edge_type"), F.concat_ws(":", F.lit("journal_article"), F.coalesce("primary_domain", F.lit("")), text("total_toc"), text("matched_toc")).alias("locator"), F.lit(None).cast("string").alias("court"), F.lit(None).cast("string").alias("date")).distinct()
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("court"), F.to_date("o_orderdate").cast("string").alias("date"))
    dated = o.select(F.concat(F.lit("o"), "o_orderkey").alias("edge_id"), F.lit("cites_judgment_by_date").alias("edge_type"), F.lit(None).cast("string").alias("locator"), "court", "date")
    index = c.select(F.col("id").alias("target"), F.col("primary_domain").alias("journal"), text("total_toc").alias("issue"), text("matched_toc").alias("page"))
    return K.cite_lookup(by.union(dated), index, o.select(F.col("o_orderkey").cast("string").alias("target"), "court", "date"), aliases=ALIASES)
