"""Queries of the general operators over whole tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import concordance as C
from folioforge.operators import ledger as L
from folioforge.operators import linkage as K
from folioforge.operators import outline as O
from folioforge.operators import profiles as P
from folioforge.operators import search as S
from folioforge.plans import sqltext as Q
from folioforge.runtime import materialize, still_there, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
TERM = "時効管理"
NODE_COLS = ["toc_node_id", "book_id", "toc_source", "idx", "depth", "title", "path_text", "page_start", "print_page", "kind", "toc_status"]
_BUILT: dict[tuple[str, str], DataFrame] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """The outline index: the latest row of each node, with its title keys ``k``, ``title_key``, ``title_loose``, ``path_key``, ``path_loose``.

    Written once a session and data directory, as an index is; every query over outlines
    reads the few columns that it needs from there, and none repeats the deduplication or the Unicode forms.
    """
    at = (spark.sparkContext.applicationId, d)
    if at not in _BUILT or not still_there(_BUILT[at]):
        latest = table(spark, d, "toc_nodes").groupBy("toc_node_id").agg(F.max(F.struct("updated_at", *NODE_COLS[1:])).alias("m")).select("toc_node_id", *[f"m.{c}" for c in NODE_COLS[1:]])
        keyed = S.search_index(latest, "title", "path_text").withColumn("k", X.toc_title_key(F.col("title")))
        _BUILT[at] = materialize(keyed, "outline-index")
    return _BUILT[at]


NODES_SQL = f"nodes AS (SELECT {', '.join(NODE_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY toc_node_id ORDER BY updated_at DESC) nth FROM toc_nodes) WHERE nth = 1)"


# ------------------------------------------------------------------ search and landing
@query(f"""WITH {NODES_SQL}, k AS (SELECT *, {Q.search_key('title')} t, {Q.search_key("coalesce(path_text, '')")} p FROM nodes),
s AS (SELECT *, CASE WHEN t = '{TERM}' THEN 100 WHEN starts_with(t, '{TERM}') THEN 80 WHEN contains(t, '{TERM}') THEN 60 WHEN contains(regexp_replace(t, '[\\s　]', '', 'g'), '{TERM}') THEN 50
 WHEN contains(p, '{TERM}') THEN 40 WHEN contains(regexp_replace(p, '[\\s　]', '', 'g'), '{TERM}') THEN 30 END + CASE WHEN page_start IS NOT NULL THEN 5 ELSE 0 END + greatest(0, 4 - coalesce(nullif(depth, 0), 1)) AS score FROM k)
SELECT toc_node_id, title, page_start, depth, score FROM s WHERE score IS NOT NULL ORDER BY score DESC, coalesce(page_start, 1000000000), toc_node_id, depth, path_text LIMIT 30""")
def search_topk(spark: SparkSession, d: str) -> DataFrame:
    """The thirty best nodes for a term, from the outline index."""
    return S.search(nodes(spark, d), TERM, page="page_start", depth="depth", tiebreak=["toc_node_id", "depth", "path_text"]).select("toc_node_id", "title", "page_start", "depth", "score")


@query(f"""WITH {NODES_SQL} SELECT book_id, toc_source, idx, toc_node_id, repeat('  ', greatest(coalesce(depth, 1), 1) - 1) || '- ' || title AS line FROM nodes WHERE length(title) >= 2""")
def outline_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Every outline as nested list lines, one row a line with its place; a book's lines are never gathered."""
    return S.outline_lines(nodes(spark, d), keep=["book_id", "toc_source", "idx", "toc_node_id"], title="title", depth="depth")


SOURCES = [("viewer", "https://viewer.invalid/{key}?page={page}"), ("shelf", None), ("partner", "https://partner.invalid/b/{key}/{page}")]


@query(f"""WITH {NODES_SQL}, src(source_id, page_url) AS (VALUES ('viewer', 'https://viewer.invalid/{{key}}?page={{page}}'), ('shelf', NULL), ('partner', 'https://partner.invalid/b/{{key}}/{{page}}')),
links AS (SELECT book_id, 'viewer' source_id, book_id book_key, page_offset."offset" off, NULL::VARCHAR loc FROM books WHERE page_offset IS NOT NULL UNION ALL SELECT book_id, 'shelf', NULL, NULL, 'stack ' || book_id FROM books WHERE has_toc),
j AS (SELECT n.toc_node_id, n.page_start, s.source_id, s.page_url, l.book_key, l.off, l.loc FROM (SELECT DISTINCT toc_node_id, book_id, page_start FROM nodes) n CROSS JOIN src s LEFT JOIN links l ON l.book_id = n.book_id AND l.source_id = s.source_id),
k AS (SELECT *, CASE WHEN book_key IS NOT NULL AND page_url IS NOT NULL AND off IS NOT NULL AND page_start IS NOT NULL THEN 'page' WHEN book_key IS NOT NULL AND page_url IS NOT NULL THEN 'book_top' WHEN loc IS NOT NULL THEN 'physical' ELSE 'unavailable' END kind FROM j)
SELECT toc_node_id, source_id, kind, CASE WHEN kind = 'page' THEN replace(replace(page_url, '{{key}}', book_key), '{{page}}', (page_start + off)::VARCHAR) END url, CASE WHEN kind = 'book_top' AND off IS NULL THEN 'offset_not_calibrated' END reason FROM k""")
def landing_links(spark: SparkSession, d: str) -> DataFrame:
    """Where each node can be opened, for every source."""
    books = table(spark, d, "books")
    links = books.where("page_offset is not null").select("book_id", F.lit("viewer").alias("source_id"), F.col("book_id").alias("book_key"), F.col("page_offset.offset").alias("offset"), F.lit(None).cast("string").alias("location"))
    links = links.union(books.where("has_toc").select("book_id", F.lit("shelf"), F.lit(None).cast("string"), F.lit(None).cast("int"), F.concat(F.lit("stack "), "book_id")))
    each = nodes(spark, d).select("toc_node_id", "book_id", F.col("page_start").alias("page")).distinct()
    return S.resolve_links(each, spark.createDataFrame(SOURCES, "source_id string, page_url string"), links).select("toc_node_id", "source_id", "kind", "url", "reason")


@query(f"""WITH {NODES_SQL}, c AS (SELECT book_id, print_page - page_start AS off, count(*) n FROM nodes WHERE print_page IS NOT NULL AND page_start IS NOT NULL GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY book_id) total, row_number() OVER (PARTITION BY book_id ORDER BY n DESC, off) k FROM c)
SELECT book_id, off AS mode, n, round(n / total, 6) AS share FROM r WHERE k = 1""")
def calibrate_offset(spark: SparkSession, d: str) -> DataFrame:
    """The commonest page offset of each book and its share."""
    each = nodes(spark, d).select("book_id", (F.col("print_page") - F.col("page_start")).alias("off"))
    return S.mode_of(each, ["book_id"], "off").withColumn("share", F.round("share", 6))


@query(f"""WITH {NODES_SQL}, n AS (SELECT book_id, count(DISTINCT toc_node_id) n_nodes, string_agg(DISTINCT toc_source, ',' ORDER BY toc_source) sources FROM nodes GROUP BY 1)
SELECT b.book_id, b.title, coalesce(n_nodes, 0) n_nodes, coalesce(sources, '') sources FROM books b LEFT JOIN n USING (book_id)""")
def book_detail(spark: SparkSession, d: str) -> DataFrame:
    """Each book with the number and sources of its nodes."""
    n = nodes(spark, d).groupBy("book_id").agg(F.count_distinct("toc_node_id").alias("n_nodes"), F.array_join(F.array_sort(F.collect_set("toc_source")), ",").alias("sources"))
    return table(spark, d, "books").join(n, "book_id", "left").select("book_id", "title", F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"), F.coalesce("sources", F.lit("")).alias("sources"))


@query("""WITH q AS (SELECT embedding e FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[])), 4) AS cosine
FROM embeddings, q ORDER BY list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[])) DESC, vec_id LIMIT 10""")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest vectors to vector 0."""
    v = table(spark, d, "embeddings")
    q = v.where("vec_id = 0").select("embedding").first()[0]
    return S.cosine_topk(v, "vec_id", "embedding", list(q), 10).withColumn("cosine", F.round("cosine", 4))


# ------------------------------------------------------------------ outlines
CLAMPED_SQL = f"{NODES_SQL}, c AS (SELECT book_id, toc_source, idx, toc_node_id, least(greatest(coalesce(depth, 1), 1), 6) AS depth FROM nodes)"


def clamped(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).select("book_id", "toc_source", "idx", "toc_node_id", F.least(F.greatest(F.coalesce("depth", F.lit(1)), F.lit(1)), F.lit(6)).alias("depth"))


_LAST = ", ".join(f"max(CASE WHEN depth = {k} THEN printf('%09d', idx) || '|' || toc_node_id END) OVER (PARTITION BY book_id, toc_source ORDER BY idx, toc_node_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) l{k}" for k in range(1, 6))


@query(f"""WITH {CLAMPED_SQL}, w AS (SELECT *, {_LAST} FROM c) SELECT book_id, toc_source, toc_node_id, depth,
split_part(greatest({', '.join(f'CASE WHEN depth > {k} THEN l{k} END' for k in range(1, 6))}), '|', 2) AS parent_id FROM w""")
def tree_parents(spark: SparkSession, d: str) -> DataFrame:
    """Each node's parent from order and depth alone; empty for none."""
    return O.parents(clamped(spark, d), ["book_id", "toc_source"], ["idx", "toc_node_id"], "toc_node_id", "depth").select("book_id", "toc_source", "toc_node_id", "depth", F.col("parent").alias("parent_id"))


@query(f"""WITH RECURSIVE {CLAMPED_SQL}, r AS (SELECT *, row_number() OVER w n, depth - min(depth) OVER (PARTITION BY book_id, toc_source) + 1 lv FROM c WINDOW w AS (PARTITION BY book_id, toc_source ORDER BY idx, toc_node_id)),
t AS (SELECT book_id, toc_source, toc_node_id, n, 1 AS new_depth FROM r WHERE n = 1 UNION ALL SELECT r.book_id, r.toc_source, r.toc_node_id, r.n, least(r.lv, t.new_depth + 1) FROM t JOIN r ON r.book_id = t.book_id AND r.toc_source = t.toc_source AND r.n = t.n + 1)
SELECT book_id, toc_source, toc_node_id, new_depth FROM t""")
def level_clamp(spark: SparkSession, d: str) -> DataFrame:
    """Depths without jumps; the twin walks row by row."""
    return O.clamp_levels(clamped(spark, d), ["book_id", "toc_source"], ["idx", "toc_node_id"], "depth", "new_depth").select("book_id", "toc_source", "toc_node_id", F.col("new_depth").cast("int").alias("new_depth"))


_B = ", ".join(f"sum(CASE WHEN depth < {k} THEN 1 ELSE 0 END) OVER w b{k}" for k in range(1, 7))
_N = ", ".join(f"sum(CASE WHEN depth = {k} THEN 1 ELSE 0 END) OVER (PARTITION BY book_id, toc_source, b{k} ORDER BY idx, toc_node_id ROWS UNBOUNDED PRECEDING)::INT n{k}" for k in range(1, 7))


@query(f"""WITH {CLAMPED_SQL}, b AS (SELECT *, {_B} FROM c WINDOW w AS (PARTITION BY book_id, toc_source ORDER BY idx, toc_node_id ROWS UNBOUNDED PRECEDING)), n AS (SELECT *, {_N} FROM b)
SELECT book_id, toc_source, toc_node_id, concat_ws('.', {', '.join(f"CASE WHEN depth >= {k} THEN printf('{'c' if k == 1 else ''}%02d', n{k}) END" for k in range(1, 7))}) AS path_no FROM n""")
def tree_path_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Path numbers by ordinals among siblings."""
    return O.path_numbers(clamped(spark, d), ["book_id", "toc_source"], ["idx", "toc_node_id"], "depth").select("book_id", "toc_source", "toc_node_id", "path_no")


GRAIN_SQL = f"{NODES_SQL}, g AS (SELECT book_id, toc_source, max(depth) max_depth, count(*) n_nodes, round(count(page_start) / count(*), 4) page_coverage FROM nodes GROUP BY 1, 2)"


@query(f"WITH {GRAIN_SQL} SELECT * FROM g")
def granularity(spark: SparkSession, d: str) -> DataFrame:
    """How fine each outline is."""
    return O.granularity(nodes(spark, d), ["book_id", "toc_source"], "depth", "page_start")


@query(f"""WITH {GRAIN_SQL}, a AS (SELECT *, max(n_nodes) OVER (PARTITION BY book_id) most FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY max_depth DESC NULLS LAST, n_nodes DESC, page_coverage DESC, toc_source) k FROM a WHERE n_nodes >= 0.2 * most)
SELECT book_id, toc_source AS base_source FROM r WHERE k = 1""")
def base_source(spark: SparkSession, d: str) -> DataFrame:
    """The outline that is each book's base."""
    return C.base_source(O.granularity(nodes(spark, d), ["book_id", "toc_source"], "depth", "page_start"), "book_id", "toc_source")


@query("""WITH s AS (SELECT doc_id, string_split(text, '。') p FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(len(p))) n, p FROM s),
v AS (SELECT doc_id, n, p[n + 1] || CASE WHEN n < len(p) - 1 THEN '。' ELSE '' END AS sentence FROM u), f AS (SELECT * FROM v WHERE sentence <> '')
SELECT doc_id, n::INT n, coalesce(sum(length(sentence)) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, length(sentence || coalesce(lead(sentence) OVER (PARTITION BY doc_id ORDER BY n), ''))::INT AS window_chars FROM f""")
def sentence_window(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of all documents with offsets and two-sentence windows."""
    return O.sentences(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "n", "start", F.length("window").alias("window_chars"))


# ------------------------------------------------------------------ concordance and adoption
KEYED_SQL = f"{NODES_SQL}, keyed AS (SELECT *, {Q.toc_title_key('title')} AS k FROM nodes)"


def keyed(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d)


@query(f"WITH {KEYED_SQL} SELECT book_id, k, count(DISTINCT toc_source) n_sources, count(*) n_nodes, CASE WHEN count(DISTINCT toc_source) >= 2 THEN 'matched' ELSE 'orphan' END kind FROM keyed WHERE coalesce(k, '') <> '' GROUP BY 1, 2")
def concordance_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Headings that several sources of a book share."""
    return C.clusters(keyed(spark, d), "book_id", "toc_source", "k")


@query(f"""WITH {KEYED_SQL}, c AS (SELECT book_id, k, count(DISTINCT toc_source) s, count(*) n FROM keyed WHERE coalesce(k, '') <> '' GROUP BY 1, 2), t AS (SELECT book_id, count(*) total, count_if(coalesce(k, '') = '') unkeyed FROM keyed GROUP BY 1),
a AS (SELECT book_id, coalesce(sum(n) FILTER (WHERE s >= 2), 0)::BIGINT matched, coalesce(sum(n) FILTER (WHERE s < 2), 0)::BIGINT orphan FROM c GROUP BY 1)
SELECT t.book_id, total, unkeyed::BIGINT unkeyed, coalesce(matched, 0) matched, coalesce(orphan, 0) orphan, total = unkeyed + coalesce(matched, 0) + coalesce(orphan, 0) accounted FROM t LEFT JOIN a USING (book_id)""")
def concordance_accounting(spark: SparkSession, d: str) -> DataFrame:
    """That no outline row is lost on the way."""
    return C.accounting(keyed(spark, d), "book_id", "toc_source", "k")


@query(f"WITH {KEYED_SQL} SELECT book_id, k, count(DISTINCT toc_source) votes, count(DISTINCT toc_source) >= 2 consensus FROM keyed WHERE coalesce(k, '') <> '' GROUP BY 1, 2")
def provenance_votes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct origins of each heading."""
    return C.votes(keyed(spark, d), "book_id", "k", "toc_source", least=2)


_SCHEME = "CASE " + " ".join(f"WHEN regexp_matches(title, {Q.quoted(p)}) THEN '{n}'" for n, p in X.NUMBERING) + " END"
CONFLICT_SQL = f"""{KEYED_SQL}, q AS (SELECT *, {_SCHEME} scheme FROM keyed WHERE coalesce(k, '') <> ''),
per AS (SELECT book_id, toc_source, count(*) n, min(depth) lo, count_if(depth = 1 AND regexp_matches(title, '{C.APPENDIX}')) bad, bool_or(depth >= 2) body, count(scheme) > 0 styled FROM q GROUP BY 1, 2),
whole AS (SELECT book_id, count(*) c, min(n) lo, max(n) hi, count_if(styled) ws FROM per GROUP BY 1), styles AS (SELECT book_id, count(DISTINCT scheme) st FROM q GROUP BY 1),
conflicts AS (SELECT book_id, 'coverage_mismatch' pattern, 'major' severity, false resolved, '' source FROM whole WHERE c >= 2 AND hi / lo >= 3
UNION ALL SELECT book_id, 'partial_toc_source', 'moderate', false, toc_source FROM per WHERE lo > 1
UNION ALL SELECT book_id, 'appendix_or_table_misclassified', 'minor', false, toc_source FROM per WHERE bad >= 2 AND body
UNION ALL SELECT DISTINCT book_id, 'same_heading_repeated_legitimately', 'info', true, toc_source FROM (SELECT book_id, toc_source FROM q GROUP BY book_id, toc_source, k HAVING count(*) > 1)
UNION ALL SELECT book_id, 'numbering_scheme_changed', 'minor', false, '' FROM whole JOIN styles USING (book_id) WHERE st >= 2 AND ws >= 2
UNION ALL SELECT DISTINCT book_id, 'orphan_quarantined', 'info', false, '' FROM (SELECT book_id FROM q GROUP BY book_id, k HAVING count(DISTINCT toc_source) < 2))"""


def _conflicts(spark: SparkSession, d: str) -> DataFrame:
    rows = keyed(spark, d).withColumn("scheme", X.numbering_scheme(F.col("title")))
    return C.conflicts(rows, book="book_id", source="toc_source", title="title", key="k", depth="depth", scheme="scheme")


@query(f"WITH {CONFLICT_SQL} SELECT * FROM conflicts")
def conflict_union(spark: SparkSession, d: str) -> DataFrame:
    """Conflicts between a book's outlines."""
    return _conflicts(spark, d)


@query(f"WITH {CONFLICT_SQL} SELECT book_id, count_if(NOT resolved)::BIGINT unresolved, CASE WHEN bool_or(severity = 'structural' AND NOT resolved) THEN 'high' WHEN count_if(NOT resolved) > 0 THEN 'medium' ELSE 'low' END risk FROM conflicts GROUP BY 1")
def risk_level(spark: SparkSession, d: str) -> DataFrame:
    """Risk of each book by its conflicts."""
    return C.risk(_conflicts(spark, d), "book_id")


@query(f"""WITH {KEYED_SQL}, v AS (SELECT book_id, k, count(DISTINCT toc_source) >= 2 consensus FROM keyed WHERE coalesce(k, '') <> '' GROUP BY 1, 2)
SELECT toc_node_id, toc_source, idx, coalesce(depth, -1) depth, CASE WHEN toc_status IS NULL THEN 'non_adoptable' WHEN NOT coalesce(consensus, false) OR coalesce(kind = 'item', false) OR page_start IS NULL THEN 'pending' ELSE 'accepted' END lane,
CASE WHEN toc_status IS NULL THEN 'source_snapshot_missing' ELSE concat_ws(',', CASE WHEN NOT coalesce(consensus, false) THEN 'non_consensus' END, CASE WHEN kind = 'item' THEN 'review' END, CASE WHEN page_start IS NULL THEN 'needs_offset' END) END reasons
FROM (SELECT DISTINCT toc_node_id, toc_source, idx, depth, book_id, k, toc_status, kind, page_start FROM keyed) n LEFT JOIN v USING (book_id, k)""")
def lane_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The adoption lane of each node."""
    rows = keyed(spark, d).select("toc_node_id", "toc_source", "idx", "depth", "book_id", "k", "toc_status", "kind", "page_start").distinct()
    voted = rows.join(C.votes(rows, "book_id", "k", "toc_source", least=2), ["book_id", "k"], "left")
    flags = voted.withColumn("snapshot", F.col("toc_status").isNotNull()).withColumn("review", F.col("kind") == "item").withColumn("needs_offset", F.col("page_start").isNull())
    out = C.lanes(flags, snapshot="snapshot", consensus="consensus", review="review", needs_offset="needs_offset")
    return out.select("toc_node_id", "toc_source", "idx", F.coalesce("depth", F.lit(-1)).alias("depth"), "lane", F.array_join("lane_reason", ",").alias("reasons"))


@query(f"""WITH {NODES_SQL}, l AS (SELECT DISTINCT book_id, md5(concat_ws(chr(31), coalesce(title, chr(1)), coalesce(depth::VARCHAR, chr(1)))) h FROM nodes), x AS (SELECT book_id, count(*) n, bit_xor(('0x' || substr(h, 1, 15))::BIGINT) a, bit_xor(('0x' || substr(h, 16, 15))::BIGINT) b FROM l GROUP BY 1)
SELECT book_id, sha256(concat_ws(':', n, a, b)) set_hash FROM x""")
def set_hash(spark: SparkSession, d: str) -> DataFrame:
    """A hash of each book's set of titles and depths."""
    return C.set_hash(nodes(spark, d), "book_id", ["title", "depth"])


SETS_SQL = f"{KEYED_SQL}, sets AS (SELECT book_id, toc_source, list_sort(list(DISTINCT k)) ks FROM keyed WHERE coalesce(k, '') <> '' GROUP BY 1, 2)"


@query(f"""WITH {SETS_SQL}, p AS (SELECT a.book_id, a.toc_source a, b.toc_source b, a.ks ka, b.ks kb, len(list_intersect(a.ks, b.ks)) i FROM sets a JOIN sets b ON a.book_id = b.book_id AND a.toc_source < b.toc_source)
SELECT book_id, a, b, round(i / (len(ka) + len(kb) - i), 6) jaccard, CASE WHEN i / least(len(ka), len(kb)) >= 0.8 AND len(kb) > len(ka) THEN 'candidate_richer' WHEN i / (len(ka) + len(kb) - i) >= 0.6 THEN 'near_duplicate' ELSE 'conflict' END kind FROM p""")
def triage_kinds(spark: SparkSession, d: str) -> DataFrame:
    """How the outlines of one book relate."""
    sets = keyed(spark, d).where("coalesce(k, '') <> ''").groupBy("book_id", "toc_source").agg(F.collect_set("k").alias("ks"))
    a, b = sets.select("book_id", F.col("toc_source").alias("a"), F.col("ks").alias("ka")), sets.select("book_id", F.col("toc_source").alias("b"), F.col("ks").alias("kb"))
    return a.join(b, "book_id").where("a < b").select("book_id", "a", "b", F.round(X.jaccard(F.col("ka"), F.col("kb")), 6).alias("jaccard"), K.triage(F.col("ka"), F.col("kb")).alias("kind"))


# ------------------------------------------------------------------ linkage
@query("""WITH r AS (SELECT DISTINCT * FROM canonical_bib), g AS (SELECT isbn, count(*) n, count(DISTINCT nullif(trim(isbn), '')) i, count(DISTINCT nullif(trim(canonical_title), '')) t, count(DISTINCT nullif(trim(edition), '')) e, count(DISTINCT nullif(trim(volume), '')) v, count(DISTINCT nullif(trim(year), '')) y,
count(DISTINCT nullif(trim(publisher), '')) p, min(page_count) FILTER (WHERE page_count > 0) lo, max(page_count) FILTER (WHERE page_count > 0) hi FROM r WHERE isbn IS NOT NULL GROUP BY 1),
h AS (SELECT *, concat_ws(',', CASE WHEN i > 1 THEN 'isbns' END, CASE WHEN t > 1 THEN 'titles' END, CASE WHEN e > 1 THEN 'editions' END, CASE WHEN v > 1 THEN 'volumes' END, CASE WHEN y > 1 THEN 'years' END, CASE WHEN (hi - lo) / hi > 0.1 THEN 'pages' END) reasons FROM g)
SELECT isbn, n, reasons, CASE WHEN n < 2 THEN 'insufficient_evidence' WHEN reasons <> '' THEN 'suspected_different_manifestation' WHEN i = 1 OR (t = 1 AND p = 1) THEN 'resolved_same_manifestation' ELSE 'insufficient_evidence' END status FROM h""")
def identity_pairs_v1(spark: SparkSession, d: str) -> DataFrame:
    """Identity of catalogue records that share an isbn."""
    r = table(spark, d, "canonical_bib").distinct().where("isbn is not null").withColumn("key", F.col("isbn"))
    return K.identity_by_group(r, "key", titles="canonical_title", publisher="publisher").withColumnRenamed("key", "isbn")


_WIDE = f"'{X.WIDE_ALNUM}', '{X.NARROW_ALNUM}'"
_ED = "nullif(regexp_extract(coalesce(%s, ''), '([0-9])(?:版|nd|rd)', 1), '')"


@query(f"""WITH v AS (SELECT DISTINCT legallib_book_id, canonical_title FROM resolver WHERE canonical_title IS NOT NULL),
p AS (SELECT DISTINCT l.legallib_book_id, r.canonical_bib_id, {Q.toc_title_key('l.legallib_title')} ta, {Q.toc_title_key('r.canonical_title')} tb, {_ED % 'l.edition'} ea, {_ED % 'r.edition'} eb, {_ED % 'l.legallib_title'} sa, {_ED % 'r.canonical_title'} sb,
l.volume va, r.volume vb, l.page_count pa, r.page_count pb, regexp_extract(translate(l.year, {_WIDE}), '(?:^|[^0-9])([0-9]{{4}})(?:[^0-9]|$)', 1) ya, regexp_extract(translate(r.year, {_WIDE}), '(?:^|[^0-9])([0-9]{{4}})(?:[^0-9]|$)', 1) yb, l.year ry, r.year rz, lower(trim(l.author)) aa, lower(trim(r.author)) ab, lower(trim(l.publisher)) ua, lower(trim(r.publisher)) ub
FROM v JOIN legallib_bib l USING (legallib_book_id) JOIN canonical_bib r USING (canonical_title)),
e AS (SELECT legallib_book_id, canonical_bib_id, CASE WHEN ea IS NULL OR eb IS NULL THEN 'UNKNOWN' WHEN ea = eb THEN 'MATCH' ELSE 'MISMATCH' END edition, CASE WHEN coalesce(va, '') = '' OR coalesce(vb, '') = '' THEN 'UNKNOWN' WHEN va = vb THEN 'MATCH' ELSE 'MISMATCH' END volume,
CASE WHEN sa IS NULL AND sb IS NULL THEN 'UNKNOWN' WHEN sa IS NULL OR sb IS NULL THEN 'ASYMMETRY' WHEN sa = sb THEN 'MATCH' ELSE 'MISMATCH' END sig, CASE WHEN coalesce(ta, '') = '' OR coalesce(tb, '') = '' THEN 'UNKNOWN' WHEN ta = tb THEN 'MATCH' WHEN contains(ta, tb) OR contains(tb, ta) THEN 'CONTAINMENT' ELSE 'DIVERGENT' END core,
CASE WHEN (trim(ry) <> '' AND ya = '') OR (trim(rz) <> '' AND yb = '') THEN 'PARSE_ERROR' WHEN coalesce(trim(ry), '') = '' OR coalesce(trim(rz), '') = '' THEN 'UNKNOWN' WHEN ya = yb THEN 'MATCH' WHEN abs(ya::INT - yb::INT) <= 1 THEN 'WITHIN' ELSE 'DIVERGENT' END yr,
CASE WHEN NOT coalesce(pa > 0 AND pb > 0, false) THEN 'UNKNOWN' WHEN abs(pa - pb) / greatest(pa, pb) <= 0.1 THEN 'MATCH' ELSE 'DIVERGENT' END pg, CASE WHEN coalesce(ua, '') = '' OR coalesce(ub, '') = '' THEN 'UNKNOWN' WHEN ua = ub THEN 'MATCH' ELSE 'MISMATCH' END pub, CASE WHEN coalesce(aa, '') = '' OR coalesce(ab, '') = '' THEN 'UNKNOWN' WHEN aa = ab THEN 'MATCH' ELSE 'MISMATCH' END au FROM p)
SELECT legallib_book_id, canonical_bib_id, CASE WHEN edition = 'MISMATCH' THEN 'suspected:edition_field_conflict' WHEN volume = 'MISMATCH' THEN 'suspected:volume_conflict' WHEN sig = 'MISMATCH' THEN 'suspected:edition_number_conflict' WHEN core = 'DIVERGENT' THEN 'suspected:genuine_title_diff' WHEN yr = 'DIVERGENT' THEN 'suspected:year_divergence'
WHEN yr = 'PARSE_ERROR' THEN 'insufficient:year_parse_error' WHEN sig = 'ASYMMETRY' THEN 'insufficient:edition_marker_asymmetry' WHEN core = 'CONTAINMENT' THEN 'insufficient:title_containment_only' WHEN pg = 'DIVERGENT' THEN 'insufficient:page_divergence' WHEN pub = 'MISMATCH' THEN 'insufficient:publisher_divergence'
WHEN core = 'MATCH' AND (edition = 'MATCH')::INT + (pub = 'MATCH')::INT + (au = 'MATCH')::INT + (pg = 'MATCH')::INT + (sig = 'MATCH')::INT + (yr IN ('MATCH', 'WITHIN'))::INT >= 2 THEN 'same:title_core_agree' ELSE 'insufficient:insufficient_positive_evidence' END status FROM e""")
def identity_pairs_v2(spark: SparkSession, d: str) -> DataFrame:
    """Identity of earlier link decisions, by evidence states."""
    v = table(spark, d, "resolver").where("canonical_title is not null").select("legallib_book_id", "canonical_title").distinct()
    sig = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), "([0-9])(?:版|nd|rd)", 1), F.lit(""))
    part = lambda p, df, key, title: df.select(
        key, title, X.toc_title_key(F.col(title)).alias(f"{p}t"), sig(F.col("edition")).alias(f"{p}e"), sig(F.col(title)).alias(f"{p}s"), F.col("volume").alias(f"{p}v"), F.col("page_count").alias(f"{p}p"),
        X.year_state(F.col("year")).alias(f"{p}y"), F.lower(F.trim("author")).alias(f"{p}a"), F.lower(F.trim("publisher")).alias(f"{p}u"),
    )
    j = v.join(part("a", table(spark, d, "legallib_bib"), "legallib_book_id", "legallib_title"), "legallib_book_id").join(part("b", table(spark, d, "canonical_bib"), "canonical_bib_id", "canonical_title"), "canonical_title")
    c = F.col
    core = F.when((F.coalesce("at", F.lit("")) == "") | (F.coalesce("bt", F.lit("")) == ""), "UNKNOWN").when(c("at") == c("bt"), "MATCH").when(c("at").contains(c("bt")) | c("bt").contains(c("at")), "CONTAINMENT").otherwise("DIVERGENT")
    title_sig = F.when(c("as").isNull() & c("bs").isNull(), "UNKNOWN").when(c("as").isNull() | c("bs").isNull(), "ASYMMETRY").when(c("as") == c("bs"), "MATCH").otherwise("MISMATCH")
    status = K.evidence_status({
        "isbn": F.lit("UNKNOWN"), "edition": K.text_evidence(c("ae"), c("be")), "volume": K.text_evidence(c("av"), c("bv")), "title_edition": title_sig, "core": core, "year": K.year_evidence(c("ay"), c("by")),
        "page": K.page_evidence(c("ap"), c("bp")), "publisher": K.text_evidence(c("au"), c("bu")), "author": K.text_evidence(c("aa"), c("ba")), "unknown_marker": F.lit(False),
    })
    return j.drop("canonical_title", "legallib_title").distinct().select("legallib_book_id", "canonical_bib_id", status.alias("status"))


_CHECK = " + ".join(f"(substr('978' || substr(r, 1, 9), {i + 1}, 1))::INT * {3 if i % 2 else 1}" for i in range(12))
ISBN_SQL = f"CASE WHEN regexp_matches(r, '^[0-9]{{13}}$') THEN r WHEN regexp_matches(r, '^[0-9]{{9}}[0-9X]$') THEN '978' || substr(r, 1, 9) || ((10 - ({_CHECK}) % 10) % 10)::VARCHAR ELSE '' END"
HELD_SQL = f"""h0 AS (SELECT DISTINCT upper(trim(internal_id)) id, upper(regexp_replace(translate(isbn, {_WIDE}), '[^0-9Xx]', '', 'g')) r, {Q.shop_title_key('title')} t, {Q.shop_title_key('author')} a, {Q.shop_title_key('publisher')} p FROM holdings WHERE internal_id IS NOT NULL AND coalesce(physical, false) OR coalesce(cut, false) OR coalesce(scanned, false)),
h AS (SELECT id, {ISBN_SQL} i, t, a, p FROM h0 WHERE id IS NOT NULL),
c0 AS (SELECT DISTINCT id, upper(regexp_replace(translate(isbn, {_WIDE}), '[^0-9Xx]', '', 'g')) r, {Q.shop_title_key('title')} t, {Q.shop_title_key('author')} a, {Q.shop_title_key('publisher')} p FROM candidates), c AS (SELECT id, {ISBN_SQL} i, t, a, p FROM c0)"""


def _shop(df: DataFrame, key) -> DataFrame:
    k = lambda c: X.shop_title_key(F.col(c))
    return df.select(key.alias("id"), X.isbn13(F.col("isbn")).alias("i"), k("title").alias("t"), k("author").alias("a"), k("publisher").alias("p")).distinct()


def _held(spark: SparkSession, d: str) -> DataFrame:
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    return _shop(table(spark, d, "holdings").where(on("physical") | on("cut") | on("scanned")), F.upper(F.trim("internal_id"))).where("id is not null")


TIERS = [("strong", "isbn", ["i"]), ("strong", "title_author", ["t", "a"]), ("soft", "title_publisher", ["t", "p"]), ("soft", "title", ["t"])]


@query(f"""WITH {HELD_SQL}, m AS (SELECT c.id, i.id i1, ta.id i2, tp.id i3, t.id i4 FROM c LEFT JOIN (SELECT i, min(id) id FROM h WHERE i <> '' GROUP BY 1) i ON i.i = c.i LEFT JOIN (SELECT t, a, min(id) id FROM h WHERE t <> '' AND a <> '' GROUP BY 1, 2) ta ON ta.t = c.t AND ta.a = c.a
LEFT JOIN (SELECT t, p, min(id) id FROM h WHERE t <> '' AND p <> '' GROUP BY 1, 2) tp ON tp.t = c.t AND tp.p = c.p LEFT JOIN (SELECT t, min(id) id FROM h WHERE t <> '' GROUP BY 1) t ON t.t = c.t)
SELECT id, CASE WHEN i1 IS NOT NULL OR i2 IS NOT NULL THEN 'strong' WHEN i3 IS NOT NULL OR i4 IS NOT NULL THEN 'soft' END strength, CASE WHEN i1 IS NOT NULL THEN 'isbn' WHEN i2 IS NOT NULL THEN 'title_author' WHEN i3 IS NOT NULL THEN 'title_publisher' WHEN i4 IS NOT NULL THEN 'title' END reason, coalesce(i1, i2, i3, i4) held FROM m""")
def strong_soft_match(spark: SparkSession, d: str) -> DataFrame:
    """The best holding for each candidate."""
    return K.best_match(_shop(table(spark, d, "candidates"), F.col("id")), _held(spark, d).withColumnRenamed("id", "held"), "id", "held", TIERS)


@query(f"WITH {HELD_SQL} SELECT DISTINCT id FROM c WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.i = c.i AND c.i <> '') AND NOT EXISTS (SELECT 1 FROM h WHERE h.t = c.t AND h.a = c.a AND c.t <> '' AND c.a <> '')")
def not_held_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Candidates without a strong match."""
    best = K.best_match(_shop(table(spark, d, "candidates"), F.col("id")), _held(spark, d).withColumnRenamed("id", "held"), "id", "held", TIERS[:2])
    return best.where("strength is null").select("id").distinct()


@query(f"""WITH {NODES_SQL}, s AS (SELECT book_id, CASE WHEN bool_and(coalesce(toc_status, '') = 'draft') THEN 'simple' ELSE 'mixed' END state, bool_or(coalesce(depth > 1, false) OR page_start IS NOT NULL) rich, bool_or(toc_source IN ('publisher', 'manual')) prot, bool_or(coalesce(toc_status = 'legallib', false)) done FROM nodes GROUP BY 1)
SELECT b.book_id, CASE WHEN state IS NULL THEN 'create' WHEN done THEN 'skip_idempotent' WHEN prot OR rich OR state <> 'simple' THEN 'route_human_review' ELSE 'overwrite_simple' END AS action FROM books b LEFT JOIN s USING (book_id)""")
def join_action(spark: SparkSession, d: str) -> DataFrame:
    """What to do with each book's outline."""
    simple = F.bool_and(F.coalesce("toc_status", F.lit("")) == "draft")
    rich = O.structurally_rich(F.col("depth"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("page_start"))
    s = nodes(spark, d).groupBy("book_id").agg(F.when(simple, "simple").otherwise("mixed").alias("state"), F.bool_or(rich).alias("rich"), F.bool_or(F.col("toc_source").isin("publisher", "manual")).alias("prot"), F.bool_or(F.coalesce(F.col("toc_status") == "legallib", F.lit(False))).alias("done"))
    return table(spark, d, "books").select("book_id").join(s, "book_id", "left").select("book_id", K.join_action(F.col("state"), F.col("rich"), F.col("prot"), F.col("done")).alias("action"))


@query("""WITH p AS (SELECT DISTINCT legallib_book_id, canonical_title FROM resolver WHERE bucket <> 'defer_new' AND canonical_title IS NOT NULL), c AS (SELECT *, count(*) OVER (PARTITION BY legallib_book_id) rights, count(*) OVER (PARTITION BY canonical_title) lefts FROM p) SELECT * FROM c WHERE rights > 1 OR lefts > 1""")
def ambiguous_links(spark: SparkSession, d: str) -> DataFrame:
    """Decisions that link one record to several."""
    return K.ambiguity(table(spark, d, "resolver").where("bucket <> 'defer_new'"), "legallib_book_id", "canonical_title")


@query("""WITH r AS (SELECT DISTINCT * FROM resolver), d AS (SELECT legallib_book_id FROM r GROUP BY 1 HAVING count(DISTINCT bucket) > 1)
SELECT legallib_book_id, 'confidence_in_range' AS rule, count(*) n FROM r WHERE NOT coalesce(resolver_confidence BETWEEN 0 AND 1, false) GROUP BY 1 UNION ALL SELECT legallib_book_id, 'known_bucket', count(*) FROM r WHERE NOT coalesce(bucket IN ('auto_accept', 'human_review', 'defer_new'), false) GROUP BY 1
UNION ALL SELECT legallib_book_id, 'accepted_has_title', count(*) FROM r WHERE NOT coalesce(bucket <> 'auto_accept' OR canonical_title IS NOT NULL, false) GROUP BY 1 UNION ALL SELECT legallib_book_id, 'one_bucket', count(*) FROM r JOIN d USING (legallib_book_id) GROUP BY 1""")
def resolver_preflight(spark: SparkSession, d: str) -> DataFrame:
    """Broken rules of the link decisions, by record."""
    r = table(spark, d, "resolver").distinct()
    several = r.groupBy("legallib_book_id").agg((F.count_distinct("bucket") > 1).alias("several"))
    rows = r.join(several, "legallib_book_id")
    broken = L.violations(rows, "legallib_book_id", {
        "confidence_in_range": F.col("resolver_confidence").between(0, 1), "known_bucket": F.col("bucket").isin("auto_accept", "human_review", "defer_new"),
        "accepted_has_title": (F.col("bucket") != "auto_accept") | F.col("canonical_title").isNotNull(), "one_bucket": ~F.col("several"),
    })
    return broken.groupBy("legallib_book_id", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT a.l_suppkey a, b.l_suppkey b, count(*) weight FROM m a JOIN m b USING (l_orderkey) WHERE a.l_suppkey < b.l_suppkey GROUP BY 1, 2""")
def cooccurrence_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers that meet in orders."""
    return K.cooccurrence(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query("""SELECT o_custkey, a.o_orderkey a, b.o_orderkey b FROM orders a JOIN orders b USING (o_custkey) WHERE a.o_orderkey < b.o_orderkey AND a.o_orderdate < b.o_orderdate + INTERVAL 14 DAY AND b.o_orderdate < a.o_orderdate + INTERVAL 14 DAY""")
def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a customer whose fortnights overlap."""
    spans = table(spark, d, "orders").where("o_orderdate is not null").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("s"), (F.col("o_orderdate") + F.expr("INTERVAL 14 DAY")).alias("e"))
    return K.overlapping(spans, "o_custkey", "o_orderkey", "s", "e")


@query("""WITH p AS (SELECT user_id, ts pts, min(event_id) pid FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) SELECT e.event_id, e.user_id, p.pid FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.pts WHERE e.event_type = 'error'""")
def asof_revision(spark: SparkSession, d: str) -> DataFrame:
    """Each error with the purchase before it."""
    e = table(spark, d, "events")
    p = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("pts")).agg(F.min("event_id").alias("pid"))
    return K.asof_join(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), p, "user_id", "ts", "pts", ["pid"]).select("event_id", "user_id", "pid")


@query("SELECT DISTINCT id, isbn FROM candidates WHERE isbn IS NOT NULL AND isbn NOT IN (SELECT isbn FROM books WHERE isbn IS NOT NULL)")
def orphan_scan(spark: SparkSession, d: str) -> DataFrame:
    """Candidates whose isbn no registered book has."""
    return table(spark, d, "candidates").where("isbn is not null").select("id", "isbn").distinct().join(table(spark, d, "books"), "isbn", "left_anti").select("id", "isbn")
