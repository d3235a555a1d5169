import hashlib
import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from folioforge import runtime
from folioforge.functions import text as X
from folioforge.functions.schema import errors
from folioforge.operators import concordance as C
from folioforge.operators import evidence as E
from folioforge.operators import ledger as L
from folioforge.operators import linkage as K
from folioforge.operators import outline as O
from folioforge.operators import revisions as V
from folioforge.operators.graph import connected_components
from folioforge.operators.hubs import cross_scheme, term_hubs
from folioforge.plans import library
from folioforge.sources import files
from folioforge.streaming import events as S


def one(spark, expr, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_text_keys(spark):
    assert one(spark, X.toc_title_key, "第１章　総則・通則", None, "") == ["第1章総則通則", None, ""]
    assert one(spark, X.toc_title_key, "甲〔乙〕、丙")[0] == "甲〔乙〕、丙" and one(spark, X.shop_title_key, "甲〔乙〕、丙")[0] == "甲乙丙"
    assert one(spark, X.search_key, "ﾃｽﾄ ABC")[0] == "てすと abc" and one(spark, X.reading_key, "ぜん・イー ")[0] == "ぜんい"
    assert one(spark, X.preferred_key, " ＡＢ１善 ")[0] == "AB1善"
    assert one(spark, X.publisher_key, "株式会社 雫島書林", "雫島書林（株）") == ["雫島書林", "雫島書林"]
    assert one(spark, X.isbn13, "４-００-３１０１０１-４", "978-4-00-310101-8", "12", None) == ["9784003101018", "9784003101018", "", None] or one(spark, X.isbn13, "978-4-00-310101-8")[0] == "9784003101018"
    assert one(spark, X.publisher_key, "独立行政法人 雫島・社", "（財）雫島社", "㈱雫島_社") == ["雫島社"] * 3
    assert one(spark, X.numbering_scheme, "第3章 x", "第三節", "Ⅳ x", "Art. 5", "4 x", "1.2 x", "(3) x", "序", None) == ["kanji_chapter", "kanji_num", "roman", "article", "arabic", "arabic", None, None, None]
    assert one(spark, X.page_basis, "本文ページ", "PDF ", "print_page", "通しページ", "x", None) == ["print_page", "pdf_page", "print_page", "pdf_page", "unknown", "unknown"]
    sizes = spark.createDataFrame([(0,), (1,), (10,), (11,), (50,), (51,)], "n int")
    assert [r[0] for r in sizes.select(X.size_bucket(F.col("n"))).collect()] == ["empty", "1-10", "1-10", "11-50", "11-50", "51+"]
    assert one(spark, lambda c: X.journal_key(c, {"法雑": "法律雑誌"}), "法 雑", "判例　１２", None) == ["法律雑誌", "判例12", ""]
    assert [r and tuple(r) for r in one(spark, X.locator_parts, "journal_article:法雑:12:5", "法雑:1:", "法雑::3", "法雑:1", None)] == [("法雑", "12", "5"), ("法雑", "1", ""), None, None, None]
    assert one(spark, X.role_stem, "a_request", "b-回答", "c") == ["a", "b", "c"] and one(spark, X.first_year, "c2019-20", "昭和", None) == ["2019", "", ""]
    assert one(spark, X.folder_name, "a/法雑/x.json", "x.json", None) == ["法雑", "", ""] and one(spark, X.cited_journal, "『法学研究（慶応）83巻,p1", "", None) == ["法学研究(慶応)", "", ""]
    assert one(spark, X.markdown_cell, "a|b\nc", None) == ["a\\|b c", ""] and [X.small_kanji_value(x) for x in ("十", "二十三", "十五", "7", "三", "百", None)] == [10, 23, 15, 7, 3, None, None]
    assert one(spark, X.kanji_number, "二十三", "百五", "千二百", "12", "甲", None) == [23, 105, 1200, 12, None, None]
    assert [tuple(x) for x in one(spark, X.year_state, "c2019", "", None, "昭和", "20190")] == [(2019, "ok"), (None, "missing"), (None, "missing"), (None, "parse_error"), (None, "parse_error")] and tuple(one(spark, X.year_state, "1234年")[0]) == (1234, "ok")
    assert one(spark, lambda c: X.stable_hash(c), None, "")[0] != one(spark, lambda c: X.stable_hash(c), "")[0]


def test_sets_and_sequences(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "a array<string>, b array<string>")
    got = df.select(X.jaccard(F.col("a"), F.col("b")), X.containment(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(pytest.approx(1 / 3), 0.5), (1.0, 0.0), (0.0, 0.0)]
    assert X.sequence_ratio("abcd", "abcd") == 1.0 and X.sequence_ratio("", "") == 1.0 and X.sequence_ratio("ab", "xyzw") < 0.6


def test_components(spark):
    e = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("x", "y"), ("y", "x"), ("z", "z"), (None, "q")], "a string, b string")
    got = {r.node: r.component for r in connected_components(e).collect()}
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"} and got["y"] == "x" and got["z"] == "z" and "q" not in got
    assert connected_components(e.limit(0)).count() == 0


def test_outline_levels(spark):
    rows = [("b", i, lv, f"n{i}") for i, lv in enumerate([2, 5, 3, 2, 4, 4, 3])]
    df = spark.createDataFrame(rows, "book string, i int, lv int, id string")
    got = {r.id: r.depth for r in O.clamp_levels(df, ["book"], ["i"], "lv").collect()}
    assert [got[f"n{i}"] for i in range(7)] == [1, 2, 2, 1, 2, 3, 2]
    d = O.clamp_levels(df, ["book"], ["i"], "lv")
    assert {r.id: r.parent for r in O.parents(d, ["book"], ["i"], "id", "depth").collect()} == {"n0": None, "n1": "n0", "n2": "n0", "n3": None, "n4": "n3", "n5": "n4", "n6": "n3"}
    assert {r.id: r.path_no for r in O.path_numbers(d, ["book"], ["i"], "depth").collect()} == {"n0": "c01", "n1": "c01.01", "n2": "c01.02", "n3": "c02", "n4": "c02.01", "n5": "c02.01.01", "n6": "c02.02"}


def test_outlines_over_chunks(spark):
    """States that chunks hand on give what a walk over the whole outline gives."""
    rng = random.Random(5)
    rows = [(b, i, rng.randint(1, 6), f"{b}{i:03d}") for b in "xyz" for i in range(90)]
    df = spark.createDataFrame(rows, "book string, i int, lv int, id string")
    want = {}
    for b in "xyz":
        mine, depth, counts, stack = [r for r in rows if r[0] == b], 0, [], []
        lo = min(r[2] for r in mine)
        for _, i, lv, k in mine:
            depth = min(lv - lo + 1, depth + 1)
            counts = counts[:depth] + [0] * (depth - len(counts))
            counts[depth - 1] += 1
            stack = [s for s in stack if s[0] < depth]
            want[k] = (depth, stack[-1][1] if stack else None, ".".join(("c%02d" if not n else "%02d") % c for n, c in enumerate(counts)), f"book:isbn:{b}:toc:{i + 1:03d}")
            stack.append((depth, k))
    for size in (7, 1000):
        d = O.clamp_levels(df, ["book"], ["i"], "lv", size=size)
        p = O.path_numbers(O.parents(d, ["book"], ["i"], "id", "depth", size=size), ["book"], ["i"], "depth", size=size)
        assert {r.id: (r.depth, r.parent, r.path_no, r.node_id) for r in O.node_ids(p, "book", ["i"], size).collect()} == want


def test_nested_rows(spark):
    inner = [{"title": "a", "children": [{"title": "b", "children": [{"title": "c"}]}, {"title": "d", "children": None}]}, {"title": "e", "children": None}]
    schema = "id string, toc array<struct<title string, children array<struct<title string, children array<struct<title string>>>>>>"
    df = spark.createDataFrame([("x", inner)], schema)
    assert [(r.title, r.depth) for r in O.nested_rows(df, "toc", 3, "id").orderBy("seq").collect()] == [("a", 1), ("b", 2), ("c", 3), ("d", 2), ("e", 1)]


def test_evidence_order(spark):
    base = {"isbn": "UNKNOWN", "edition": "UNKNOWN", "volume": "UNKNOWN", "title_edition": "UNKNOWN", "core": "MATCH", "year": "UNKNOWN", "page": "UNKNOWN", "publisher": "UNKNOWN", "author": "UNKNOWN"}
    cases = [
        ({"isbn": "MISMATCH"}, "suspected:isbn_mismatch"), ({"isbn": "MATCH", "year": "DIVERGENT"}, "insufficient:year_divergence_anomaly"), ({"year": "DIVERGENT"}, "suspected:year_divergence"), ({"isbn": "MATCH", "core": "CONTAINMENT"}, "same:isbn_match"),
        ({"core": "CONTAINMENT"}, "insufficient:title_containment_only"), ({"publisher": "MATCH", "year": "WITHIN"}, "same:title_core_agree"), ({"publisher": "MATCH"}, "insufficient:insufficient_positive_evidence"), ({"isbn": "MATCH", "page": "DIVERGENT"}, "insufficient:page_divergence"),
    ]
    for change, want in cases:
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in (base | change).items()], F.lit(False).alias("unknown_marker"))
        assert row.select(K.evidence_status({c: F.col(c) for c in row.columns})).first()[0] == want


def test_conflicts_and_lanes(spark):
    rows = [("b", "s1", t, d) for t, d in (("索引", 1), ("別表", 1), ("第1章 総則", 1), ("第1節 x", 2), ("小括", 2), ("小括", 2))] + [("b", "s2", "総則", 2)]
    df = spark.createDataFrame(rows, "book string, src string, title string, depth int").withColumn("k", X.toc_title_key(F.col("title"))).withColumn("scheme", X.numbering_scheme(F.col("title")))
    found = {(r.pattern, r.source) for r in C.conflicts(df, book="book", source="src", title="title", key="k", depth="depth", scheme="scheme").collect()}
    assert found == {("coverage_mismatch", ""), ("partial_toc_source", "s2"), ("appendix_or_table_misclassified", "s1"), ("same_heading_repeated_legitimately", "s1"), ("orphan_quarantined", "")}
    n = spark.createDataFrame([(None, True, False, False), (True, True, False, False), (True, None, True, True)], "s boolean, c boolean, r boolean, o boolean")
    assert [(r.lane, r.lane_reason) for r in C.lanes(n, snapshot="s", consensus="c", review="r", needs_offset="o").collect()] == [("non_adoptable", ["source_snapshot_missing"]), ("accepted", []), ("pending", ["non_consensus", "review", "needs_offset"])]


def test_quarantine_fold(spark):
    log = [("k", 1, "enter"), ("k", 2, "escape"), ("k", 3, "release"), ("k", 4, "enter"), ("m", 1, "release"), ("m", 2, "enter"), ("p", 1, "enter"), ("p", 2, "enter"), ("q", 1, "recur"), ("r", 1, "enter"), ("r", 2, "release")]
    df = spark.createDataFrame([(k, s, t, float(s), "why") for k, s, t in log], "k string, seq int, t string, e double, reason string")
    got = {r.k: (r.open, r.recurred, r.released, r.escapes) for r in L.quarantine_fold(df, "k", ["seq"], "t", "e", "reason").collect()}
    assert got == {"k": (True, True, True, 1), "m": (True, True, True, 0), "p": (True, False, False, 0), "q": (True, True, False, 0), "r": (False, False, True, 0)}
    kpi = L.quarantine_kpi(L.quarantine_fold(df, "k", ["seq"], "t", "e", "reason"), 86404.0).first()
    assert (kpi.open_count, kpi.escape_events, kpi.recurrence_rate) == (4, 1, 1.0) and kpi.max_age_days == pytest.approx(1 + 3 / 86400)
    assert L.quarantine_kpi(L.quarantine_fold(df.limit(0), "k", ["seq"], "t", "e", "reason"), 1.0).first().open_count == 0


def test_hash_chain(spark):
    rows, prev = [], ""
    for n in range(5):
        own = hashlib.sha256("\x1f".join([prev, str(n), f"d{n}"]).encode()).hexdigest()
        rows.append(["g", n, f"d{n}", prev, own])
        prev = own
    check = lambda rs: [tuple(r) for r in L.chain_breaks(spark.createDataFrame([tuple(r) for r in rs], "g string, n int, d string, prev string, own string"), "g", "n", ["n", "d"], "prev", "own").collect()]
    assert check(rows) == []
    rows[3][2] = "tampered"
    assert check(rows) == [("g", 3)]


def test_repairs_are_idempotent_and_reversible(spark):
    now = spark.createDataFrame([("a", 1, " x"), ("b", 2, "y"), ("c", None, None)], "id string, n int, t string")
    want = now.withColumn("t", F.trim("t")).withColumn("n", F.coalesce("n", F.lit(7)))
    plan = L.repair_plan(now, want, ["id"], ["n", "t"])
    assert {(r.id, r.field, r.after) for r in plan.collect()} == {("a", "t", "x"), ("c", "n", "7")}
    after = L.apply_plan(now, plan, ["id"], ["n", "t"])
    assert L.repair_plan(after, want, ["id"], ["n", "t"]).count() == 0
    assert sorted(map(tuple, L.apply_plan(after, plan, ["id"], ["n", "t"], "before").collect())) == sorted(map(tuple, now.collect()))


def test_versions_and_gates(spark):
    old = spark.createDataFrame([("a", "1", 3), ("b", "2", 1)], "id string, row_hash string, version int")
    new = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", "5")], "id string, row_hash string")
    assert {tuple(r) for r in L.versioned_upsert(old, new, "id", []).collect()} == {("a", "1", 3), ("b", "9", 2), ("c", "5", 1)}
    g = spark.createDataFrame([("a", None), ("b", 1), ("c", -1)], "id string, n int")
    assert {tuple(r) for r in L.violations(g, "id", {"positive": F.col("n") > 0}).collect()} == {("a", "positive"), ("c", "positive")}


def test_asof_and_spans(spark):
    a = spark.createDataFrame([("k", 5), ("k", 1), ("j", 3)], "k string, t int")
    b = spark.createDataFrame([("k", 2, "x"), ("k", 5, "y"), ("j", 9, "z")], "k string, rt int, v string")
    assert {tuple(r) for r in K.asof_join(a, b, "k", "t", "rt", ["v"]).collect()} == {("k", 5, 5, "y"), ("k", 1, None, None), ("j", 3, None, None)}
    s = spark.createDataFrame([("l", "a", 1, 3), ("l", "b", 3, None), ("l", "c", None, 2), ("l", "d", 9, 10)], "l string, k string, s int, e int")
    assert {(r.a, r.b) for r in K.overlapping(s, "l", "k", "s", "e").collect()} == {("a", "c"), ("b", "d")}


def test_spans_of_any_length(spark):
    """Spans of all lengths, open, empty and repeated ones against all pairs; the longest has more units than a row per unit allows."""
    rnd = random.Random(7)
    lengths = [-3, 0, 1, 14, 17, 500, 4_000, 10**10, 2**62]
    rows = [(rnd.choice(["l", "m", None]), rnd.randint(0, 90), s if rnd.random() > 0.05 else None, s + rnd.choice(lengths) if rnd.random() > 0.05 else None) for s in (rnd.randint(-2_000, 2_000) for _ in range(150))]
    rows += [("l", 91, -(2**63), 2**63 - 1), ("m", 92, -(2**63), 5)]
    before = lambda x, y: x is None or y is None or x < y
    empty = lambda r: None not in r[2:] and r[2] >= r[3]
    meet = lambda x, y: before(x[2], y[3]) and before(y[2], x[3]) and not ((empty(x) or empty(y)) and None not in x[2:] + y[2:])
    want = sorted((x[0], x[1], y[1]) for x in rows for y in rows if x[0] and x[0] == y[0] and x[1] < y[1] and meet(x, y))
    got = K.overlapping(spark.createDataFrame(rows, "l string, k int, s bigint, e bigint"), "l", "k", "s", "e")
    assert sorted(map(tuple, got.collect())) == want


def test_interval_overlap_places_a_row_less_than_twice(spark, tmp_path):
    """Equal to its SQL where dates are missing and rows stand twice; what is joined follows the rows and not their days."""
    c = duckdb.connect()
    c.execute("""create table orders as select i::bigint o_orderkey, i % 40 o_custkey, timestamp '1995-01-01' + to_hours((i * 7919 % 20000)::int) o_orderdate from range(2000) t(i)
      union all select 5000 + i, i % 40, null from range(50) t(i) union all select 7, 7, timestamp '1995-01-01' + to_hours((7 * 7919 % 20000)::int) from range(2)""")
    c.execute(f"copy orders to '{tmp_path}/orders.parquet' (format parquet)")
    df = library.QUERIES["interval_overlap"](spark, str(tmp_path))
    assert sorted(map(tuple, df.collect())) == sorted(c.execute(library.ORACLES["interval_overlap"]).fetchall())
    plan, placed = [df._jdf.queryExecution().executedPlan()], []
    while plan:
        at = plan.pop()
        plan += [at.executedPlan()] if at.nodeName() == "AdaptiveSparkPlan" else [at.plan()] if at.nodeName().endswith("QueryStage") else []
        plan += [at.children().apply(i) for i in range(at.children().size())]
        if at.nodeName() == "Generate":
            placed.append(at.metrics().apply("numOutputRows").value())
    assert 2002 <= max(placed) < 2 * 2002


def test_revisions(spark):
    """Each kind of change in a law of its own."""
    long = "代理人がその権限内において本人のためにすることを示してした意思表示は、本人に対して直接にその効力を生ずる。"
    other = "債権者は、債務者がその債務を履行しないときは、損害の賠償を請求することができる。"
    third = "保佐人の同意を要する行為について、その同意を得なければならない。"
    row = lambda p, t, d=False, c=None: (f"art:{p}", p, c, t, d)
    cases = [
        ([row("1", long)], [row("1", "  " + long)], {("1", "no_change")}),
        ([row("1", long)], [row("1", long.replace("直接に", "当然に"))], {("1", "substitution")}),
        ([row("1", long)], [row("2", long)], {("1", "renumber")}),
        ([row("1", long + other)], [row("1", long), row("1-2", other)], {("1", "split")}),
        ([row("1", long + other)], [row("3", long), row("4", other)], {("1", "split")}),
        ([row("1", long), row("2", other)], [row("1", long + other)], {("1", "join")}),
        ([row("1", long)], [row("1", None, True), row("9", other)], {("1", "repeal"), ("9", "insertion")}),
        ([row("1", None, True)], [row("1", long)], {("1", "insertion")}),
        ([row("1", long)], [], {("1", "repeal")}),
        ([row("1", None, True)], [], set()),
        # two articles one number further, one of them edited, are a block; the new text at the old number is an insertion
        ([row("20", third), row("21", other)], [row("20", long), row("21", third + "ただし、日用品の購入については、この限りでない。"), row("22", other)], {("20", "renumber"), ("21", "renumber"), ("20", "insertion")}),
        ([row("1", long), row("9", "別")], [row("7", long.replace("直接に", "当然に").replace("その権限内において", "")), row("9", "別")], {("1", "relocate"), ("9", "no_change")}),
        ([row("1", long), row("2", third)], [row("1", long + third)], {("1", "join")}),
        # a number used again for an unlike text, and no better partner
        ([row("1", long)], [row("1", "甲乙丙")], {("1", "substitution")}),
    ]
    schema = "law_id string, article_path string, article_number string, caption string, text string, deleted boolean"
    old, new = (spark.createDataFrame([(f"l{k}", *r) for k, c in enumerate(cases) for r in c[side]], schema) for side in (0, 1))
    got = {}
    for r in V.revision_deltas(old, new).collect():
        got.setdefault(r.law_id, set()).add((r.article_path[4:], r.delta_kind))
    assert got == {f"l{k}": want for k, (_, _, want) in enumerate(cases) if want}
    assert V.revision_deltas(old.limit(0), new.limit(0)).count() == 0
    ops = spark.createDataFrame([("abc", "abd"), ("aaa", None)], "o string, n string").select(V.diff_ops("o", "n").alias("d")).collect()
    assert [(x.op, x.a, x.b) for x in ops[0].d.opcodes] == [("replace", [2, 3], [2, 3])] and not ops[0].d.truncated and ops[1].d.opcodes[0].op == "delete"


def test_best_pairs_against_a_sorted_walk(spark):
    rng = random.Random(4)
    rows = [(law, f"o{i}", f"n{k}", rng.choice([0.6, 0.7, 0.8, 0.9])) for law in "xy" for i in range(8) for k in range(8) if rng.random() < 0.5]
    want, used = set(), set()
    for law, o, n, s in sorted(rows, key=lambda r: (r[0], -r[3], r[1], r[2])):
        if not {(law, o), (law, n)} & used:
            used |= {(law, o), (law, n)}
            want.add((law, o, n, s))
    assert {tuple(r) for r in V.best_first(spark.createDataFrame(rows, "law_id string, o string, n string, score double")).select("law_id", "o", "n", "score").collect()} == want


def test_disputes_and_hubs(spark):
    a = spark.createDataFrame([("a1", "t", "continues", 1), ("a2", "t", "changed", 2), ("a3", "t", "neutral", 2), ("a4", "u", "disputed", 1)], "k string, target string, stance string, tier int")
    found, rows = E.disputes(a, "k", "target", "stance", "tier")
    assert [(r.target, r.continuity_side, r.change_side) for r in found.collect()] == [("t", ["a1"], ["a2"])]
    assert {(r.k, r.status, r.counter_key) for r in rows.collect()} == {("a1", "disputed", "a2"), ("a2", "disputed", "a1"), ("a3", "candidate", None), ("a4", "candidate", None)}
    views = {r.target: r for r in E.provision_views(a.withColumn("src", F.lit("court")), "target", "k", "stance", "src", "tier").collect()}
    assert (views["t"].disposition, views["t"].both_sides_required, len(views["t"].claims)) == ("disputed", True, 3) and "undecided" in views["t"].summary and views["u"].disposition == "one_sided_change"
    shown = E.view_markdown(E.provision_views(a.withColumn("src", F.lit("court")), "target", "k", "stance", "src", "tier"), "target").where("target = 't'").first().text
    assert shown.startswith("## t\n") and "- [continuity] a1 (court, tier 1)" in shown
    bound = E.bound_claims(spark.createDataFrame([("d", "c1", "followed"), ("d", "c2", "overruled")], "id string, citation string, treatment string"), spark.createDataFrame([("d", "c1", "art:1"), ("d", "c2", None)], "id string, citation string, article_path string"), ["id", "citation"])
    assert [(r.citation, r.article_path, r.stance) for r in bound.collect()] == [("c1", "art:1", "continues")]
    kinds = spark.createDataFrame([("transition_type", "interpretation_modified"), ("change_type", "x"), (None, "followed"), ("treatment_relation", None)], "s string, v string")
    assert [r[0] for r in kinds.select(E.stance(F.col("s"), F.col("v"))).collect()] == ["qualified", "unknown", "unknown", "unknown"]
    terms = spark.createDataFrame([("1", "A", "101", "1", "甲", "こう", "一二三四五六七八九"), ("2", "B", "101", "1", "甲", "コウ", None), ("3", "A", "101", "1", "甲", "こう", "まったく別の意味の語")], "term_id string, scheme_id string, authority_rank string, term_tier string, pref string, reading string, definition string")
    hubs = term_hubs(terms)
    assert {r.term_id: r.map_type for r in hubs.collect()} == {"1": "skos_exact_match", "2": "skos_exact_match", "3": "homograph_split"}
    assert cross_scheme(hubs, terms).count() == 1


def test_treatments(spark):
    docs = spark.createDataFrame([("d", "最判平成3年4月5日は事案を異にする。最大判昭和48年4月4日がある。次の文で判例を変更する。"), ("e", "東京地裁平成2年1月1日の記録。"), ("f", None)], "id string, text string")
    got = {(r.citation, r.treatment) for r in E.treatments(docs, "id", "text").collect()}
    assert got == {("最判平成3年4月5日", "distinguished"), ("最大判昭和48年4月4日", "overruled")}


def test_schema_rules():
    s = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "string", "pattern": "^x", "minLength": 2}, "n": {"$ref": "#/defs/n"}, "l": {"type": "array", "minItems": 1, "items": {"enum": [1, 2]}}, "o": {"oneOf": [{"const": 1}, {"type": "integer"}]}}, "defs": {"n": {"type": ["integer", "null"], "maximum": 3}}}
    assert errors({"a": "xy", "n": None, "l": [1], "o": 2}, s, s) == []
    assert sorted(errors({"a": "y", "n": 4, "l": [3], "o": 1, "z": 1}, s, s)) == ["$.a: length", "$.a: pattern", "$.l[0]: enum", "$.n: range", "$.o: oneOf", "$.z: additional"]
    assert errors({"n": True}, s, s) == ["$.a: required", "$.n: type"] and errors([], s, s) == ["$: type"]


def test_streams_agree_with_batches(spark, tmp_path):
    rows = [(i, f"2026-01-01 {h:02d}:{m:02d}:00", u, float(i)) for i, (h, m, u) in enumerate([(0, 0, "a"), (0, 20, "a"), (1, 30, "a"), (0, 5, "b"), (3, 0, "b"), (3, 10, "b")])]
    df = spark.createDataFrame(rows, "id int, t string, u string, value double").select("id", F.col("t").cast("timestamp").alias("ts"), "u", "value")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = S.read_events(spark, str(tmp_path / "in"), df.schema)
    for n, f in enumerate([lambda x: S.sessions(x, "ts", "u", "30 minutes"), lambda x: S.tumbling(x, "ts", "u", "1 hour"), lambda x: S.sliding(x, "ts", "u", "1 hour", "30 minutes"), lambda x: S.latest(x, "u", ["ts"], ["ts", "value"])]):
        assert sorted(map(tuple, S.run_to_table(f(stream), str(tmp_path / f"out{n}")).collect())) == sorted(map(tuple, f(df).collect()))


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","t":"a b"}\r\n\n{"_comment":"x"}\n{"id":"2","t":null}\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "id string, t string", "id").collect()] == [("1", "a b"), ("2", None)]
    (tmp_path / "b.csv").write_bytes("﻿id,t\n1,x\n".encode())
    assert [r.asDict() for r in files.read_csv(spark, str(tmp_path / "b.csv")).collect()] == [{"id": "1", "t": "x"}]
    d = tmp_path / "dir"
    d.mkdir()
    (d / "k1.json").write_text('{"n": 1}')
    (d / "k2.json").write_text("{broken")
    (d / "index.json").write_text("{}")
    got = files.read_json_dir(spark, str(d), "n int", ("index.json",))
    assert {(r.stem, r.state) for r in got.collect()} == {("k1", "ok"), ("k2", "unreadable")}
    keys = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "k string")
    assert {tuple(r) for r in files.file_states(keys, "k", got).collect()} == {("k1", "ok"), ("k2", "unreadable"), ("k3", "absent")}
    (tmp_path / "m.md").write_text("---\nstatus: done # note\nid: r-1\n---\n\n  PASS_x\nbody\n")
    m = files.read_front_matter(spark, str(tmp_path / "m.md")).first()
    assert (m.meta["status"], m.meta["id"], m.label) == ("done", "r-1", "PASS_x")
    (tmp_path / "law.xml").write_text("<Law><MainProvision><Article Num='3_2'><ArticleCaption>（題）</ArticleCaption><Paragraph><ParagraphNum>1</ParagraphNum><ParagraphSentence><Sentence>文で&quot;ある&quot;。</Sentence></ParagraphSentence><Item><ItemTitle>一</ItemTitle><ItemSentence><Column><Sentence>甲</Sentence></Column></ItemSentence></Item></Paragraph></Article><Article Num='4' Delete='true'/></MainProvision><SupplProvision><Article Num='9'/></SupplProvision></Law>", encoding="utf-8")
    (tmp_path / "no.xml").write_text("<Law>")
    x = files.read_statute_xml(spark, str(tmp_path / "*.xml")).orderBy("order_index").collect()
    assert [(r.article_number, r.caption, r.text, r.deleted) for r in x] == [("3-2", "（題）", '1文で"ある"。一甲', False), ("4", None, "", True)]
    f = files.fingerprint(spark, str(d)).collect()
    assert len(f) == 3 and len({r.fingerprint for r in f}) == 1
    files.write_staged(keys, str(tmp_path / "t"))
    files.write_staged(keys.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1 and spark.read.parquet(str(tmp_path / "t.bak")).count() == 3
    s = files.synthetic_outlines(spark, 20)
    assert s.count() == s.distinct().count() and {r.depth for r in s.select("depth").distinct().collect()} == {1, 2, 3}
    v = spark.createDataFrame([("[1,2]",), ('{"nodes":[3]}',), ('{"x":1}',)], "j string").select(F.parse_json("j").alias("v"))
    assert [r[0] for r in v.select(F.to_json(files.locate_nodes(F.col("v")))).collect()] == ["[1,2]", "[3]", None]
    assert files.remap(keys, {"key": "k", "k": "x"}).columns == ["key"]


def test_runtime(spark):
    df = spark.range(5).withColumn("t", F.lit("x"))
    assert runtime.materialize(df).count() == 5 and runtime.shared_dir(spark).startswith("file://")
    import shutil

    made = runtime.materialize(df, "gone")
    assert runtime.still_there(made)
    shutil.rmtree(made.inputFiles()[0].removeprefix("file://").rpartition("/")[0])
    assert not runtime.still_there(made)
    wide = df.withColumn("t", F.repeat(F.lit("x"), 1000))
    assert "broadcast" in runtime.checked_broadcast(df)._jdf.queryExecution().toString().lower() and "broadcast" not in runtime.checked_broadcast(wide, most_bytes=100)._jdf.queryExecution().logical().toString().lower()
    assert runtime.partitions_for(100, 10, spark) == 10 and runtime.partitions_for(1, 10, spark) == 4
    assert json.dumps(runtime.checked_broadcast(df, 2).columns) == '["id", "t"]'


def test_repairers(spark):
    from folioforge.operators import repair as R

    nodes = spark.createDataFrame(
        [("b", "s1", 0, "総則", None, 12, None, None), ("b", "s1", 1, "独自の章", "独自の章", 13, 3, None), ("b", "s2", 0, "総 則", "総則", None, None, None), ("b", "s2", 1, "索引", "索引", None, None, None), ("c", "s1", 0, "単独", "単独", 5, None, None)],
        "book_id string, source string, idx int, title string, title_norm string, page int, print_page int, quarantine_reason string",
    )
    books = spark.createDataFrame(
        [("b", "s1", (10, 1.0, True, 2), "text", None, None, None), ("b", "s2", (10, 1.0, True, 2), None, None, None, None), ("c", "s1", (1, 0.9, True, 5), "x", "done", None, None)],
        "book_id string, source string, page_offset struct<offset:int,confidence:double,validated:boolean,anchors:int>, source_content string, source_sha256 string, sparse boolean, multi_volume boolean",
    )
    plan = R.plan_all(nodes, books.dropDuplicates(["book_id"]).unionByName(books.limit(0)), "derive").collect()
    assert {(r.repairer, r.book_id, r.source, r.idx, r.after) for r in plan if r.field != "source_sha256"} == {("offset_page@1", "b", "s1", 0, "2"), ("title_norm@1", "b", "s1", 0, "総則"), ("orphan_quarantine@1", "b", "s1", 1, "orphan")}
    assert {r.repairer: r.may_apply for r in plan}["orphan_quarantine@1"] is False
    with pytest.raises(ValueError):
        R.repairer("offset_page", "derived")(lambda n, b: n)


def test_gates(spark):
    from folioforge.operators import gates as G

    stages = spark.createDataFrame([("a", "count"), ("b", "count"), ("b", "count"), ("c", "odd")], "stage string, probe string")
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "gone")], "a string, b string")
    assert {tuple(r) for r in G.manifest_gates(stages, edges, ["count"]).collect()} == {("b", "duplicate_id"), ("gone", "unknown_dependency"), ("c", "bad_probe"), ("a", "cycle"), ("b", "cycle")}
    bad = spark.createDataFrame([("l", "p", "split", 0.5, ["x"]), ("l", "q", "no_change", 1.0, []), ("l", "r", "what", 2.0, [])], "law_id string, article_path string, delta_kind string, similarity double, counterpart_paths array<string>")
    found = G.delta_gates(bad)
    assert {tuple(r) for r in found.collect()} == {("l/p", "parts_named"), ("l/r", "known_kind"), ("l/p", "provenance"), ("l/q", "provenance"), ("l/r", "provenance")}
    told = lambda df: df.withColumns({c: F.lit("x") for c in ("detector_version", "source_snapshot_id", "from_revision", "to_revision")})
    moved = spark.createDataFrame([("l", "art:20", "renumber", 0.7, ["art:21"]), ("l", "art:21", "renumber", 0.95, ["art:22"]), ("m", "art:20", "renumber", 0.7, ["art:21"]), ("l", "art:5", "renumber", 0.5, ["art:6"]), ("l", "art:9", "no_change", 0.9, [])], bad.schema)
    assert {tuple(r) for r in G.delta_gates(told(moved)).collect()} == {("m/art:20", "new_number_justified"), ("l/art:5", "new_number_justified"), ("l/art:9", "unchanged_text")}
    assert {r.rule for r in G.delta_gates(told(moved.limit(1)).withColumn("stance", F.lit("x"))).collect()} >= {"nothing_of_substance"}
    t = spark.createDataFrame([("a", "candidate", False, "followed", "c", 0, 5, None, "low"), ("b", "accepted", True, "odd", "", 5, 5, None, "high"), ("c", "candidate", False, "overruled", "c", 0, 5, None, "medium")], "k string, status string, claim_support boolean, treatment string, citation string, span_start int, span_end int, cue string, confidence string")
    assert {tuple(r) for r in G.treatment_gates(t, "k").collect()} == {*{("b", x) for x in ("candidate", "no_claim_support", "known_treatment", "evidence_span", "no_high_confidence")}, ("c", "strong_has_cue")}
    dr = spark.createDataFrame([("a", "candidate", False, 2, "legislative_drafter", "scope_expansion", "q", "cue", "low", "art:1"), ("b", "candidate", None, 1, "court", "x", None, None, None, None)], "k string, status string, claim_support boolean, source_tier int, source_type string, change_type string, quoted_text string, cue string, confidence string, article_path string")
    assert {tuple(r) for r in G.drafter_gates(dr, "k").collect()} == {("b", x) for x in ("tier_2", "known_change", "evidence", "cue", "no_high_confidence", "provision")}
    cl = spark.createDataFrame([("a", "disputed", "b", "d", False, False), ("b", "accepted", "b", None, True, True), ("c", "disputed", None, None, True, None)], "k string, status string, counter_key string, dispute_id string, claim_support boolean, lawtime_resolved boolean")
    ev = spark.createDataFrame([("e", "accepted", None)], "event_id string, new_status string, basis string")
    dd = spark.createDataFrame([("d", ["a"], [])], "dispute_id string, continuity_side array<string>, change_side array<string>")
    assert {tuple(r) for r in G.dispute_gates(dd, cl, ev, "k").collect()} == {("b", "counter_blocks"), ("b", "support_needs_acceptance"), ("b", "no_self_counter"), ("c", "support_needs_acceptance"), ("c", "disputed_is_told"), ("e", "never_accepts"), ("e", "basis"), ("d", "both_sides")}
    v = E.provision_views(spark.createDataFrame([("x", "t", "continues", "court", 1), ("y", "t", "changed", None, 1)], "k string, target string, stance string, src string, tier int"), "target", "k", "stance", "src", "tier")
    assert {tuple(r) for r in G.view_gates(v, "target").collect()} == {("t", "attributed")}
    assert {r.gate: r.ok for r in G.passed({"x": found, "y": found.limit(0)}).collect()} == {"x": False, "y": True}


def test_drafter_claims(spark):
    docs = spark.createDataFrame([("d", "改正後第四百二十三条の二第1項は、従来の解釈を変更するものではない。旧第10条は別である。"), ("e", "第5条を読む。")], "id string, text string")
    assert {(r.article_path, r.side, r.change_type) for r in E.drafter_claims(docs, "id", "text").collect()} == {("art:423-2:para:1", "after", "no_substantive_change")}
    one = E.drafter_claims(docs.withColumn("hint", F.lit("国会審議")), "id", "text", F.col("hint")).first()
    assert (one.source_type, one.source_tier, one.confirmatory) == ("legislative_record", 2, True)
    sides = spark.createDataFrame([("旧民法",), ("新法",), ("現行の",), ("改正前",), ("民法",)], "p string")
    assert [r[0] for r in sides.select(E.revision_side(F.col("p"))).collect()] == ["before", "after", "current", "before", "unknown"]


def test_thresholds():
    from folioforge.config import Thresholds

    t = Thresholds().override(edition_classifier_version="v2", overlap=0.5)
    assert t.classifier() == "v2" and t.overlap == 0.5 and Thresholds(edition_classifier_version="v9").classifier() == "v1"
    with pytest.raises(ValueError):
        Thresholds().override(overlapp=1)


def test_work_in_progress(spark):
    from folioforge.operators import operations as W

    o = spark.createDataFrame([("i", "f1", "ndl", 1, "A", "o1"), ("i", "f2", "x", 2, "B", "o2"), ("i", "f2", "x", 3, "A", "o3"), ("j", "f1", "x", 1, "C", "o4"), ("j", "f1", "x", 1, None, "o5")], "item string, fam string, src string, t int, v string, obs string").withColumn("at", F.timestamp_seconds("t")).withColumn("pr", F.when(F.col("src") == "ndl", 1).otherwise(2))
    got = {r.item: (r.adopted, r.status, r.contributor_obs) for r in W.adopt_observations(o, ["item"], value="v", family="fam", priority="pr", at="at", obs="obs").collect()}
    assert got == {"i": ("A", "corroborated", ["o1", "o3"]), "j": ("C", "single_authority", ["o4"])}
    r = spark.createDataFrame([(None, 1, False), (2, 1, True), (2, 1, False), (1, 1, False), (1, 2, False)], "o int, n int, m boolean")
    assert [x[0] for x in r.select(W.rank_replace(F.col("o"), F.col("n"), F.col("m"))).collect()] == ["create", "skip_manual", "replace", "append_missing", "skip_lower"]
    n = spark.createDataFrame([("a", None, "h"), ("b", "a", None), ("c", "b", "r"), ("x", "y", None), ("y", "x", None)], "id string, parent string, kind string")
    assert {tuple(x) for x in W.nearest_of_kind(n, "id", "parent", "kind", "h").collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", None), ("y", None)}


def test_specified_operators(spark):
    from folioforge.operators import operations as W

    o = spark.createDataFrame([("o1", None, 1), ("o2", "o1", 2), ("o3", "o2", 9)], "obs string, sup string, f int")
    assert [r.obs for r in W.active_observations(o, "obs", "sup", "f", 5).collect()] == ["o2"]
    e = spark.createDataFrame([("k", "a"), ("k", "a"), ("m", "a"), ("m", "b"), ("m", None)], "k string, fam string")
    assert {(r.k, r.confirmed) for r in W.confirmed(e, ["k"], "fam").collect()} == {("k", False), ("m", True)}
    pro, con = W.weighted_evidence({"x": (F.lit(True), 2), "y": (F.lit(None).cast("boolean"), 5), "z": (F.lit(True), -1)})
    assert tuple(spark.range(1).select(pro, con).first()) == (2.0, 1.0)
    t = spark.createDataFrame([("A", "a", "a", "a"), ("A", "A", "a", "a"), ("A", "B", "a", "b")], "a string, b string, pa string, pb string")
    no = F.lit(False)
    assert [r[0] for r in t.select(W.dispute_triage(F.col("a"), F.col("b"), F.col("pa"), F.col("pb"), no, no, no)).collect()] == ["equivalent_after_normalization", None, "true_conflict"]
    n = spark.createDataFrame([("p", "t", [("DOI", "d"), ("X", "x")], [("甲", "n1"), ("乙", None)]), ("q", "u", [], [])], "id string, title string, ids array<struct<type string, value string>>, authors array<struct<name string, nrid string>>")
    articles, authors = W.publications(n, "id")
    assert {(r.id, r.doi, r.naid) for r in articles.collect()} == {("p", "d", None), ("q", None, None)} and {(r.position, r.name) for r in authors.collect()} == {(1, "甲"), (2, "乙")}
    c = spark.createDataFrame([("甲・乙「判批」法誌１２巻3号45頁（2019年）",), ("雑文",)], "line string")
    got = W.commentary_lines(c, "line").collect()
    assert (got[0].parsed, got[0].authors, got[0].journal, got[0].volume, got[0].page, got[0].year) == (True, ["甲", "乙"], "法誌", 12, 45, 2019) and not got[1].parsed
