import random
from datetime import datetime

import numpy as np
import pytest

from folioforge.operators import hierarchy as H

SCHEMA = "toc_node_id string, parent string, title string, book string, idx int, depth int, path string, updated_at timestamp, i string, b string, label string"
T0 = datetime(2026, 1, 1)


def frame(spark, rows):
    """rows: id, parent, title, book, idx, depth, path"""
    return spark.createDataFrame([(*r, T0, "x", None, "y") for r in rows], SCHEMA)


def resolve(spark, rows, **options):
    out = H.hierarchy(frame(spark, rows), key="toc_node_id", parent="parent", title="title", group="book", order="idx", at="updated_at", compare_depth="depth", compare_path="path", **options)
    return {r["id"]: r for r in out.collect()}, {tuple(r) for r in H.hierarchy_defects(out).collect()}


def brute(rows):
    node = {r[0]: r for r in rows}
    res, defects = {}, set()
    for v in node:
        chain, seen, x = [], {}, v
        while True:
            if x in seen:
                kind = "cycle"
                break
            seen[x] = len(chain)
            chain.append(x)
            p = node[x][1]
            if not p:
                kind = "tree"
                break
            if p not in node:
                kind = "orphan"
                break
            x = p
        if kind == "cycle":
            ring = chain[seen[x]:]
            res[v] = ("cycle" if v in ring else "below_cycle", min(ring), None)
            defects.add((v, res[v][0], min(ring)))
        elif kind == "orphan":
            res[v] = ("orphan" if len(chain) == 1 else "below_orphan", None, None)
            if len(chain) == 1:
                defects.add((v, "orphan", node[v][1]))
        else:
            path = " > ".join(node[y][2] or "" for y in reversed(chain))
            res[v] = ("tree", chain[-1], (len(chain), path))
            if node[v][5] is not None and node[v][5] != len(chain):
                defects.add((v, "depth", chain[-1]))
            if node[v][6] is not None and node[v][6] != path:
                defects.add((v, "path", chain[-1]))
    return res, defects


def rows_of(seed, n, links):
    rng = random.Random(seed)
    ids = [f"n{k:04d}" for k in range(n)]
    rng.shuffle(ids)
    rows = []
    for k, i in enumerate(ids):
        parent = links(rng, k, ids)
        rows.append((i, parent, rng.choice(["t", "ab", None, "章"]), rng.choice(["x", "x", "y"]), k if seed % 2 else 0, rng.choice([None, 1, 2, 3]), rng.choice([None, "t", "t > ab", "t > ", ""])))
    return rows


CASES = {
    "forest": lambda rng, k, ids: ids[rng.randrange(k)] if k and rng.random() < 0.9 else rng.choice([None, ""]),
    "chain": lambda rng, k, ids: ids[k - 1] if k else None,
    "any": lambda rng, k, ids: rng.choice(ids) if rng.random() < 0.8 else rng.choice([None, "", "gone"]),
    "ring": lambda rng, k, ids: ids[(k + 1) % len(ids)],
    "self": lambda rng, k, ids: ids[k] if rng.random() < 0.3 else ids[max(0, k - 1)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("task_rows", [100_000, 12, 3])
def test_against_brute_force(spark, case, task_rows):
    """Whole groups in a task, trees across chunks, and trees larger than a task give the same."""
    rows = rows_of(len(case), 60, CASES[case])
    want, defects = brute(rows)
    got, found = resolve(spark, rows, task_rows=task_rows)
    assert found == defects
    if task_rows == 12:  # the same without making paths
        assert resolve(spark, rows, task_rows=task_rows, all_paths=False)[1] == defects
    assert got.keys() == want.keys()
    kids = {}
    for r in rows:
        kids.setdefault(r[1], []).append(r[0])
    for v, (state, anchor, tree) in want.items():
        g = got[v]
        assert g["state"] == state and (tree or g["path"] is None)
        if tree:
            assert (g["root"], g["depth"], g["path"]) == (anchor, *tree)
            below = [w for w, o in got.items() if o["root"] == g["root"] and g["entry"] < o["entry"] < g["exit"]]
            stack, want_below = list(kids.get(v, [])), []
            while stack:
                x = stack.pop()
                want_below.append(x)
                stack += kids.get(x, [])
            assert sorted(below) == sorted(want_below) and g["n_descendants"] == len(below)


def test_repeats_nulls_and_empty(spark):
    from datetime import timedelta

    rows = [("a", None, "t", "x", 1, 1, "t"), ("b", "a", "u", "x", 2, 2, "t > u"), (None, "a", "u", "x", 3, 2, None), ("b", "a", "u", "x", 2, 2, "t > u")]
    late = spark.createDataFrame([("b", "", "u", None, None, 1, "u", T0 + timedelta(days=1), "x", None, "y")], SCHEMA)
    df = frame(spark, rows).union(late)
    out = H.hierarchy(df, key="toc_node_id", parent="parent", title="title", group="book", order="idx", at="updated_at", compare_depth="depth", compare_path="path")
    assert {(r.id, r.root, r.depth, r.path) for r in out.collect()} == {("a", "a", 1, "t"), ("b", "b", 1, "u")}
    assert H.hierarchy_defects(out).collect() == []
    assert resolve(spark, []) == ({}, set())


def test_long_chain_arrays():
    n = 20_000
    parent = np.arange(n) - 1
    entry, out, depth, root = H.euler(parent, np.arange(n))
    assert (depth == np.arange(1, n + 1)).all() and (root == 0).all() and (entry == np.arange(n)).all() and (out == 2 * n - 1 - np.arange(n)).all()
    assert not H.peel(parent).any()


def test_descendant_pairs(spark):
    rows = [("a", None, "t", "x", 1, None, None), ("b", "a", "u", "x", 2, None, None), ("c", "b", "v", "x", 3, None, None), ("d", None, "w", "x", 4, None, None)]
    out = H.hierarchy(frame(spark, rows), key="toc_node_id", parent="parent", title="title", group="book", order="idx", at="updated_at")
    assert {tuple(r) for r in H.descendants(out).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}


def test_giant_cycle_folds_no_text(spark):
    """A cycle far larger than a task, with trees hanging on it, gives ids and states of fixed size."""
    n = 3000
    rows = [(f"n{k:05d}", f"n{(k + 1) % n:05d}", "題" * 10, "x", k, None, "題") for k in range(n)] + [(f"m{k:05d}", f"n{k:05d}" if k % 2 else f"m{k - 1:05d}", "t", "x", k, None, None) for k in range(1, 300)]
    rows += [("r", None, "根", "x", 0, 1, "根"), *[(f"t{k:04d}", "r" if not k else f"t{k - 1:04d}", "枝", "x", k, None, "根" + " > 枝" * (k + 1) + ("" if k % 3 else "!")) for k in range(700)]]
    got, found = resolve(spark, rows, task_rows=500, all_paths=False)
    assert sum(r["state"] == "cycle" for r in got.values()) == n
    assert {d for d in found if d[1] == "path"} == {(f"t{k:04d}", "path", "r") for k in range(0, 700, 3)}
    assert got["t0699"]["depth"] == 701 and got["r"]["n_descendants"] == 700


def test_descendants_in_slices(spark):
    rows = rows_of(7, 80, CASES["forest"])
    out = H.hierarchy(frame(spark, rows), key="toc_node_id", parent="parent", title="title", group="book", order="idx", at="updated_at")
    kids, want = {}, set()
    for r in rows:
        kids.setdefault(r[1] or None, []).append(r[0])

    def walk(v, above):
        want.update((a, v, len(above) - k) for k, a in enumerate(above))
        for c in kids.get(v, []):
            walk(c, [*above, v])

    for v in kids[None]:
        walk(v, [])
    for size in (4, 1 << 12):
        assert {tuple(r) for r in H.descendants(out, size).collect()} == want
