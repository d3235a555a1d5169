"""Queries of projections, reports and vocabularies over whole tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import lawtime as T
from folioforge.operators import profiles as R
from folioforge.operators import projections as P
from folioforge.operators import vocabulary as V
from folioforge.plans import sqltext as Q
from folioforge.plans.library import NODES_SQL, nodes
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


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) n, (count(DISTINCT l_suppkey) * (count(DISTINCT l_suppkey) - 1) // 2)::BIGINT pairs FROM lineitem GROUP BY 1")
def naive_pairs(spark: SparkSession, d: str) -> DataFrame:
    """How many pairs of suppliers each order would make."""
    return P.pair_count(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query(f"""WITH {NODES_SQL}, a AS (SELECT DISTINCT book_id, title FROM nodes WHERE toc_source = 'legallib'), b AS (SELECT DISTINCT book_id, title FROM nodes WHERE toc_source <> 'legallib' AND book_id IN (SELECT book_id FROM a))
SELECT coalesce(a.book_id, b.book_id) book_id, coalesce(a.title, b.title) title, CASE WHEN a.book_id IS NULL THEN 'added' ELSE 'removed' END AS change FROM a FULL OUTER JOIN b ON a.book_id = b.book_id AND a.title = b.title WHERE a.book_id IS NULL OR b.book_id IS NULL""")
def title_changes(spark: SparkSession, d: str) -> DataFrame:
    """Headings that one source of a book has and its others have not, or the other way round."""
    n = nodes(spark, d).select("book_id", "toc_source", "title")
    a = n.where("toc_source = 'legallib'")
    b = n.where("toc_source <> 'legallib'").join(a.select("book_id").distinct(), "book_id", "left_semi")
    return P.title_changes(a, b, ["book_id"], "title")


@query("""SELECT 'key' AS measure, k AS value, n FROM (SELECT unnest(['isbn', 'kind', 'toc_status']) k, unnest([count(isbn), count(kind), count(toc_status)]) n FROM toc_nodes) WHERE n > 0 UNION ALL SELECT 'level', coalesce(depth::VARCHAR, 'none'), count(*) FROM toc_nodes GROUP BY 2
UNION ALL SELECT 'total', unnest(['rows', 'empty_title', 'with_page']), unnest([count(*), count_if(coalesce(trim(title), '') = '')::BIGINT, count(page_start)]) FROM toc_nodes""")
def directory_profile(spark: SparkSession, d: str) -> DataFrame:
    """How the delivered nodes are filled."""
    return P.directory_profile(table(spark, d, "toc_nodes"), ["isbn", "kind", "toc_status"], "title", "depth", "page_start")


@query("""SELECT toc_node_id, title, greatest(coalesce(depth, 1), 1) AS level, CASE WHEN page_start IS NOT NULL THEN CASE WHEN page_start > 0 THEN page_start END WHEN print_page > 0 THEN print_page END AS page FROM (SELECT DISTINCT toc_node_id, trim(title) title, depth, page_start, print_page FROM toc_nodes) WHERE title <> ''""")
def canonical_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Delivered nodes under canonical names."""
    n = table(spark, d, "toc_nodes").select("toc_node_id", F.trim("title").alias("title"), "depth", "page_start", "print_page").distinct()
    return P.canonical_nodes(n, ["toc_node_id"])


TERM = "会社法実務の手引"
_GRAMS = lambda e: f"list_distinct(list_transform(range(1, length({e}) + 2), lambda i: substring('  ' || lower({e}) || ' ', i, 3)))"


@query(f"""WITH b AS (SELECT book_id, {_GRAMS('title')} g FROM books WHERE title IS NOT NULL), q AS (SELECT {_GRAMS(Q.quoted(TERM))} g), s AS (SELECT book_id, len(list_intersect(b.g, q.g)) k, len(b.g) na, len(q.g) nb FROM b, q) SELECT '{TERM}' AS query, book_id, round(k / (na + nb - k), 6) similarity FROM s WHERE k > 0 AND k / (na + nb - k) >= 0.1""")
def trigram_search(spark: SparkSession, d: str) -> DataFrame:
    """Books whose titles share trigrams with a phrase."""
    q = spark.createDataFrame([(TERM,)], "q string")
    return P.trigram_candidates(table(spark, d, "books"), q, "book_id", "title", "q", 0.1).withColumn("similarity", F.round("similarity", 6))


_STATE = "CASE o_orderstatus WHEN 'O' THEN 'CurrentEnforced' WHEN 'F' THEN 'PreviousEnforced' ELSE 'UnEnforced' END"


@query(f"""WITH r AS (SELECT o_custkey law_id, {_STATE} s, o_orderdate d FROM orders) SELECT law_id, CASE WHEN bool_or(s = 'CurrentEnforced') THEN 'in_force' WHEN bool_or(s = 'PreviousEnforced') THEN 'superseded' ELSE 'not_yet_in_force' END formal_status, max(d) FILTER (WHERE s = 'CurrentEnforced') current_from FROM r GROUP BY 1""")
def law_status(spark: SparkSession, d: str) -> DataFrame:
    """The formal state of each law, customers' orders standing for revisions."""
    r = table(spark, d, "orders").select(F.col("o_custkey").alias("law_id"), F.expr(_STATE).alias("revision_status"), F.col("o_orderdate").alias("valid_from"))
    return T.formal_status(r)


@query("""WITH k AS (SELECT lang, doc_kind, count(*) n FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2), c AS (SELECT lang FROM k GROUP BY 1 HAVING sum(n) >= 50 AND max(n) FILTER (WHERE doc_kind IS NOT NULL) / sum(n) < 0.5 AND count_if(n >= 5 AND doc_kind IS NOT NULL) >= 4)
SELECT doc_id, coalesce(CASE WHEN c.lang IS NOT NULL THEN coalesce(nullif(doc_kind, ''), d.lang) ELSE d.lang END, '') AS journal, CASE WHEN c.lang IS NOT NULL AND coalesce(doc_kind, '') <> '' THEN 'cited_in_catch_all' WHEN c.lang IS NOT NULL THEN 'folder_fallback' ELSE 'folder' END journal_source FROM documents d LEFT JOIN c ON c.lang = d.lang""")
def journal_relabel(spark: SparkSession, d: str) -> DataFrame:
    """Documents by their folder (language), or in catch-all folders by what they cite (their kind)."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "doc_kind")
    mixed = R.catch_all(docs, "lang", "doc_kind", least=50, part_least=5).select(F.col("lang").alias("folder"))
    out = V.relabel(docs, F.col("lang"), F.col("doc_kind"), mixed, {}, {})
    return out.select("doc_id", F.coalesce("journal", F.lit("")).alias("journal"), "journal_source")


@query("""WITH a AS (SELECT DISTINCT legallib_book_id author_id, author name, publisher aff FROM legallib_bib), p AS (SELECT canonical_bib_id person_id, author name, publisher aff FROM canonical_bib), x AS (SELECT name, aff, min(person_id) p FROM p WHERE name <> '' AND aff <> '' GROUP BY 1, 2), y AS (SELECT name, min(person_id) p FROM p WHERE name <> '' GROUP BY 1)
SELECT author_id, coalesce(x.p, y.p) person_id, CASE WHEN x.p IS NOT NULL THEN 'name_affiliation' WHEN y.p IS NOT NULL THEN 'name' END basis, CASE WHEN x.p IS NOT NULL THEN 'medium' WHEN y.p IS NOT NULL THEN 'low' END confidence, CASE WHEN coalesce(x.p, y.p) IS NOT NULL THEN 'candidate' ELSE 'unlinked' END status FROM a LEFT JOIN x ON x.name = a.name AND x.aff = a.aff LEFT JOIN y ON y.name = a.name""")
def author_links(spark: SparkSession, d: str) -> DataFrame:
    """Authors of delivered records among those of the catalogue: by name and publisher, else by name."""
    a = table(spark, d, "legallib_bib").select(F.col("legallib_book_id").alias("author_id"), F.col("author").alias("name"), F.lit(None).cast("string").alias("nrid"), F.col("publisher").alias("affiliation")).distinct()
    p = table(spark, d, "canonical_bib").select(F.col("canonical_bib_id").alias("person_id"), F.col("author").alias("name"), F.lit(None).cast("string").alias("nrid"), F.col("publisher").alias("affiliation"))
    return V.author_links(a, p)


@query(f"""WITH {NODES_SQL}, w AS (SELECT book_id, kind, count(*) n FROM nodes WHERE kind IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY n DESC, kind) k FROM w) SELECT book_id, string_agg(kind, ',' ORDER BY k) AS kinds FROM r WHERE k <= 2 GROUP BY 1""")
def top_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The two commonest kinds of node of each book."""
    w = nodes(spark, d).where("kind is not null").groupBy("book_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    return P.top_labels(w, "book_id", "kind", "n", 2).select("book_id", F.array_join("labels", ",").alias("kinds"))


@query("""WITH t AS (SELECT DISTINCT legallib_book_id, year_gap, bucket FROM resolver) SELECT bucket, count_if(NOT coalesce(abs(year_gap) <= 1, false))::BIGINT suspects, count(*) n FROM t GROUP BY 1""")
def real_suspects(spark: SparkSession, d: str) -> DataFrame:
    """Decisions whose gap of years is more than noise, by bucket."""
    t = table(spark, d, "resolver").select("legallib_book_id", "year_gap", "bucket").distinct()
    none = F.lit(None).cast("int")
    return t.groupBy("bucket").agg(F.count_if(P.real_suspect(F.col("year_gap"), none, none)).alias("suspects"), F.count(F.lit(1)).alias("n"))
