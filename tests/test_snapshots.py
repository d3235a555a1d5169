import random

import numpy as np

from folioforge.operators import snapshots as S

COLS = "internal_id string, title string, tags array<string>, source_record_hash string, load_run_id string, ingested_at timestamp, key string, at string"
RUNS = "load_run_id string, loaded_at timestamp"


def run(spark, rows, runs, **options):
    from datetime import datetime, timedelta

    t0 = datetime(2026, 1, 1)
    data = [(i, t, g, h, r, t0 + timedelta(minutes=m), "x", None) for i, t, g, h, r, m in rows]
    df = spark.createDataFrame(data, COLS)
    rs = spark.createDataFrame([(r, t0 + timedelta(days=n)) for n, r in enumerate(runs)], RUNS)
    out = S.snapshot_changes(df, rs, key="internal_id", run="load_run_id", at="ingested_at", digest="source_record_hash", run_at="loaded_at", **options)
    return {tuple(x) for x in out.collect()}


def test_hashes_match_sparks(spark):
    rng = random.Random(1)
    ks = [rng.getrandbits(64) - (1 << 63) for _ in range(50)]
    vs = [rng.getrandbits(64) - (1 << 63) for _ in range(50)]
    df = spark.createDataFrame(list(zip(ks, vs)), "k long, v long").selectExpr("k", "v", "xxhash64(k, v) c", *[f"pmod(xxhash64({i}, k), 37) s{i}" for i in range(S.HASHES)]).collect()
    k, v = np.array([r.k for r in df]), np.array([r.v for r in df])
    assert (S._check_of(k, v) == np.array([r.c for r in df])).all()
    assert [s.tolist() for s in S._slots(k, 37)] == [[i * 37 + r[f"s{i}"] for r in df] for i in range(S.HASHES)]


def test_cases(spark):
    rows = [
        ("a", "t", None, "sha256:AB", "r1", 0), (" A ", "t2", None, "ab", "r2", 0),  # another notation, same record
        ("b", "t", None, "1", "r1", 0), ("b", "t", None, "2", "r2", 0),
        ("c", "t", ["x"], None, "r1", 0), ("c", "t", ["x"], "9", "r2", 0),  # a missing hash: contents decide
        ("d", "t", ["x"], None, "r1", 0), ("d", "t", ["y"], None, "r2", 0),
        ("e", "t", None, "1", "r1", 0), ("f", "t", None, "1", "r2", 0),
        (None, "t", None, "1", "r2", 0), ("  ", "t", None, "1", "r2", 0), ("g", "t", None, "1", None, 0), ("g", "t", None, "1", "other", 0),
        ("h", "t", None, "1", "r1", 0), ("h", "t", None, "1", "r1", 0), ("h", "t", None, "3", "r2", 1), ("h", "t", None, "1", "r2", 2),  # the latest counts
        ("i", None, None, None, "r1", 0), ("i", None, None, None, "r2", 0),
    ]
    assert run(spark, rows, ["r1", "r2"]) == {("r2", "B", "changed"), ("r2", "D", "changed"), ("r2", "E", "removed"), ("r2", "F", "added")}


def test_against_brute_force_with_tiny_tables(spark):
    rng = random.Random(7)
    rows, want = [], set()
    state = {}
    for n, r in enumerate(["r0", "r1", "r2", "r3"]):
        new = dict(state)
        for k in range(300):
            if rng.random() < (0.9 if r == "r2" else 0.1):
                new.pop(f"K{k}", None) if rng.random() < 0.3 else new.__setitem__(f"K{k}", str(rng.random()))
        rows += [(k, "t", None, h, r, 0) for k, h in new.items()]
        if n:
            want |= {(r, k, "added") for k in new.keys() - state.keys()} | {(r, k, "removed") for k in state.keys() - new.keys()} | {(r, k, "changed") for k in new.keys() & state.keys() if new[k] != state[k]}
        state = new
    # small tables fail, grow and at last are compared whole; the result is the same
    for options in ({}, {"cells": 4, "per_bucket": 64}, {"cells": 2, "per_bucket": 400, "rounds": 1}):
        assert run(spark, rows, ["r0", "r1", "r2", "r3"], **options) == want


def test_empty(spark):
    assert run(spark, [], ["r1", "r2"]) == set()
    assert run(spark, [("a", "t", None, "1", "r1", 0)], ["r1"]) == set()
    assert run(spark, [("a", "t", None, "1", "r1", 0)], []) == set()
    assert run(spark, [("a", "t", None, "1", "r1", 0)], ["r1", "r2"]) == {("r2", "A", "removed")}
