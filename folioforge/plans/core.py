"""Queries of the core problems (snapshots, hierarchies) and of the general operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.hierarchy import descendants, hierarchy, hierarchy_defects
from folioforge.operators.snapshots import snapshot_changes
from folioforge.runtime import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Records added, removed or changed from one load run to the next."""
    found = snapshot_changes(
        table(spark, d, "holdings"), table(spark, d, "load_run"),
        key="internal_id", run="load_run_id", at="ingested_at", digest="source_record_hash", run_at="loaded_at",
    )
    return found.select(F.col("run").alias("load_run_id"), F.col("key").alias("internal_id"), "change_type")


def outline_nodes(spark: SparkSession, d: str, **options) -> DataFrame:
    """The outline nodes as hierarchies, with stored depths and paths compared."""
    return hierarchy(
        table(spark, d, "toc_nodes"), key="toc_node_id", parent="parent_toc_node_id", title="title", group="book_id", order="idx", at="updated_at",
        compare_depth="depth", compare_path="path_text", **options,
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Links that form no tree, and stored depths and paths that differ from the derived ones."""
    return hierarchy_defects(outline_nodes(spark, d, all_paths=False)).withColumnRenamed("id", "toc_node_id")


def p5_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Root, depth, path and number of descendants of every node in a tree."""
    return outline_nodes(spark, d).where("state = 'tree'").select("id", "root", "depth", "path", "n_descendants")


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Every node below every node of a tree, with how far below it lies."""
    return descendants(outline_nodes(spark, d, all_paths=False))


QUERIES = {f.__name__: f for f in (p4_found, p5_found, p5_nodes, p5_descendants)}
#: the exact comparison of consecutive runs, as SQL writes it
P4_SQL = r"""WITH r AS (SELECT load_run_id, row_number() OVER (ORDER BY loaded_at, load_run_id) s FROM load_run),
h AS (SELECT upper(trim(internal_id, ' ' || chr(12288) || chr(9) || chr(10))) id, load_run_id, s, nullif(regexp_replace(lower(source_record_hash), '^[a-z0-9]+:', ''), '') hh, ingested_at, to_json(struct_pack(isbn, bencom_id, title, title_norm, author, author_norm, publisher, publisher_norm, genre, ndc, physical, cut, scanned, has_toc))::VARCHAR cc FROM holdings JOIN r USING (load_run_id) WHERE internal_id IS NOT NULL),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, s ORDER BY ingested_at DESC) n FROM h WHERE id <> '') WHERE n = 1)
SELECT * FROM (SELECT b.load_run_id, b.id AS internal_id, CASE WHEN a.id IS NULL THEN 'added' WHEN CASE WHEN a.hh IS NOT NULL AND b.hh IS NOT NULL THEN a.hh <> b.hh ELSE a.cc <> b.cc END THEN 'changed' END change_type FROM k b LEFT JOIN k a ON a.id = b.id AND a.s = b.s - 1 WHERE b.s > 1) WHERE change_type IS NOT NULL
UNION ALL SELECT r.load_run_id, a.id, 'removed' FROM k a JOIN r ON r.s = a.s + 1 LEFT JOIN k b ON b.id = a.id AND b.s = r.s WHERE b.id IS NULL"""
#: every node walks up its links, at most as far as the table is long
WALK_SQL = """WITH RECURSIVE n AS (SELECT toc_node_id id, nullif(parent_toc_node_id, '') p, depth, title, path_text FROM (SELECT *, row_number() OVER (PARTITION BY toc_node_id ORDER BY updated_at DESC) k FROM toc_nodes) WHERE k = 1),
w AS (SELECT id, id AS cur, p, coalesce(title, '') AS path, 1 AS d, [id] AS seen, false AS looped FROM n UNION ALL SELECT w.id, n.id, n.p, coalesce(n.title, '') || ' > ' || w.path, w.d + 1, list_append(w.seen, n.id), list_contains(w.seen, n.id) FROM w JOIN n ON n.id = w.p WHERE NOT w.looped),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d DESC) k FROM w) WHERE k = 1),
f AS (SELECT e.*, CASE WHEN looped THEN list_slice(seen, list_position(seen, cur)::INT, len(seen)::INT - 1) END ring FROM e),
g AS (SELECT f.id, f.cur, f.p, f.path, f.d, looped, list_contains(ring, f.id) AS on_ring, list_min(ring) AS least, n.depth, n.path_text, n.p AS own_parent FROM f JOIN n ON n.id = f.id)"""
P5_SQL = WALK_SQL + """ SELECT id AS toc_node_id, CASE WHEN on_ring THEN 'cycle' ELSE 'below_cycle' END AS defect, least AS anchor_id FROM g WHERE looped UNION ALL SELECT id, 'orphan', p FROM g WHERE NOT looped AND p IS NOT NULL AND d = 1
UNION ALL SELECT id, 'depth', cur FROM g WHERE NOT looped AND p IS NULL AND depth <> d UNION ALL SELECT id, 'path', cur FROM g WHERE NOT looped AND p IS NULL AND path_text <> path"""
NODES_SQL = WALK_SQL + ", below AS (SELECT cur, count(*) - 1 AS n FROM w GROUP BY cur) SELECT g.id, g.cur AS root, g.d AS depth, g.path, below.n AS n_descendants FROM g JOIN below ON below.cur = g.id WHERE NOT looped AND p IS NULL"
BELOW_SQL = WALK_SQL + " SELECT w.cur AS ancestor, w.id, (w.d - 1)::BIGINT AS distance FROM w JOIN g ON g.id = w.id WHERE NOT g.looped AND g.p IS NULL AND w.d > 1"
ORACLES: dict[str, str] = {"p4_found": P4_SQL, "p5_found": P5_SQL, "p5_nodes": NODES_SQL, "p5_descendants": BELOW_SQL}
