"""Adoption, joining, citations, vocabularies, claims in time, projections, ledgers, streams and sinks on small tables."""

import pytest
from pyspark.sql import functions as F

from folioforge.operators import adoption as A
from folioforge.operators import concordance as C
from folioforge.operators import joining as J
from folioforge.operators import lawtime as T
from folioforge.operators import ledger as L
from folioforge.operators import linkage as K
from folioforge.operators import projections as P
from folioforge.operators import vocabulary as V
from folioforge.sources import files
from folioforge.streaming import events as S


def test_base_of_an_outline(spark):
    rows = [
        ("a", "pub", 1, 5, 1.0), ("a", "scan", 3, 40, 0.5), ("b", "pub", 2, 10, 1.0), ("b", "scan", 2, 12, 0.0), ("c", "pub", 2, 1, 0.0), ("c", "scan", 2, 30, 0.0),
        ("d", "hand", 2, 3, 0.0), ("d", "scan", 3, 50, 0.0), ("e", "pub", 1, 4, 0.0),
    ]
    stats = spark.createDataFrame(rows, "book string, source string, max_depth int, n_nodes int, page_coverage double")
    got = {r.book: (r.base, r.reason) for r in A.choose_base(stats, ["hand", "pub", "scan"], protected=("hand",)).collect()}
    assert got == {"a": ("scan", "flat incumbent gives way"), "b": ("pub", "incumbent kept"), "c": ("scan", "candidate by the guard"), "d": ("scan", "candidate by the guard"), "e": ("pub", "incumbent kept")}


def chain(spark, nodes, sources, books, pairs, priority=("pub", "ndl", "scan", "parts"), least=3):
    n = spark.createDataFrame(nodes, "book string, source string, idx int, title string, k string, depth int, page int, page_is_pdf boolean, part_kind string, author string")
    s = spark.createDataFrame(sources, "book string, source string, provenance_origin string, source_sha256 string, page_basis string")
    b = spark.createDataFrame(books, "book string, page_offset struct<offset:int,confidence:double,validated:boolean,anchors:int>")
    p = spark.createDataFrame(pairs, "book string, a string, b string, status string")
    cluster = A.identity_clusters(p, s, n, list(priority))
    inside = n.join(cluster.where("in_cluster").select("book", "source"), ["book", "source"], "left_semi")
    from folioforge.operators.outline import granularity

    stats = granularity(inside, ["book", "source"], "depth", "page")
    base = A.choose_base(stats, list(priority))
    laned = A.lanes(A.complete(inside, s, b, base, list(priority), ("parts",)), inside, s, cluster, least)
    return n, s, b, cluster, stats, base, laned


def test_adoption_chain(spark):
    node = lambda s, i, k, d=1, p=None, pdf=False, kind=None: ("x", s, i, k, k, d, p, pdf, kind, None)
    nodes = [node("pub", 0, "総則", 1, 3), node("pub", 1, "定義", 2, 4), node("ndl", 0, "総則"), node("ndl", 1, "定義", 2), node("ndl", 2, "雑則", 1), node("scan", 0, "総則", 1, 13, True), node("scan", 1, "定義", 2, 14, True), node("scan", 2, "附則", 1, 99, True), node("parts", 0, "巻", 1, None, False, "volume_structure"), node("other", 0, "別本")]
    sources = [("x", "pub", "publisher", "s1", "print"), ("x", "ndl", "ndl", "s2", None), ("x", "scan", "scan", None, "pdf"), ("x", "parts", "parts", "s4", None), ("x", "other", "other", "s5", None), ("y", "pub", "publisher", "s6", None)]
    pairs = [("x", "ndl", "pub", "same:isbn_match"), ("x", "pub", "scan", "resolved_same_manifestation"), ("x", "parts", "scan", "same:isbn_match"), ("x", "other", "pub", "suspected:isbn_mismatch")]
    books = [("x", (10, 1.0, True, 3)), ("y", None)]
    n, s, b, cluster, stats, base, laned = chain(spark, nodes, sources, books, pairs)
    assert {(r.source, r.in_cluster) for r in cluster.where("book = 'x'").collect()} == {("pub", True), ("ndl", True), ("scan", True), ("parts", True), ("other", False)}
    got = {(r.source, r.k): (r.lane, r.lane_reason, r.page, r.page_basis, r.votes) for r in laned.collect()}
    assert got == {
        ("pub", "総則"): ("accepted", [], 3, "print_page", 3), ("pub", "定義"): ("accepted", [], 4, "print_page", 3), ("ndl", "雑則"): ("pending", ["non_consensus"], None, "unknown", 1),
        ("scan", "附則"): ("non_adoptable", ["source_snapshot_missing"], 89, "print_page", 1), ("parts", "巻"): ("rejected", ["part_kind"], None, "unknown", 1),
    }
    accepted = A.linked(laned, ["pub", "ndl", "scan", "parts"])
    ids = {r.k: (r.toc_node_id, r.parent_id) for r in accepted.collect()}
    assert ids["総則"][1] is None and ids["定義"][1] == ids["総則"][0]
    identity = spark.createDataFrame([("x", "resolved_same_manifestation"), ("y", "insufficient_evidence")], "book string, status string")
    authority = spark.createDataFrame([("x", "consensus"), ("y", "human_review")], "book string, authority string")
    envelope = A.envelopes(b, identity, base, laned, accepted, authority)
    e = {r.book: (r.base_source, r.accepted, r.blockers, r.adoptable) for r in envelope.collect()}
    assert e == {"x": ("pub", 2, ["non_consensus_or_empty", "non_adoptable_nodes_present"], False), "y": (None, 0, ["no_base"], False)}
    assert [tuple(r) for r in A.base_distribution(accepted).collect()] == [("x", "pub", 2)]
    assert A.rollup(envelope).first().asDict() == {"books": 2, "adoptable": 0, "accepted": 2, "pending": 1}
    assert A.adoption_gates(envelope, laned, accepted, n, s, stats).count() == 0
    bad = accepted.withColumn("votes", F.lit(9)).withColumn("source_hash", F.lit(None).cast("string")).withColumn("idx", F.lit(77))
    gold = spark.createDataFrame([("g1", True, False), ("g2", True, True)], "case_id string, expected_same boolean, got_same boolean")
    broken = {r.gate for r in A.adoption_gates(envelope.withColumn("report_only", F.lit(False)), laned, bad, n, s, stats, gold=gold).collect()}
    assert broken == {"provenance_complete", "no_invention", "votes_by_origin", "report_only", "accepted_is_sound", "identity_regression"}
    # the same with sources in another order; another base is told apart
    again = chain(spark, list(reversed(nodes)), list(reversed(sources)), books, pairs)
    same = A.envelopes(b, identity, again[5], again[6], A.linked(again[6], ["pub", "ndl", "scan", "parts"]), authority)
    assert A.same_projection(envelope, same, accepted, A.linked(again[6], ["pub", "ndl", "scan", "parts"])).count() == 0
    assert {r.rule for r in A.same_projection(envelope, same.withColumn("base_source", F.lit("z")).where("book = 'x'"), accepted, accepted.limit(1)).where("book = 'x'").collect()} == {"same_base", "same_nodes"}


def test_conflicts_with_bibliography(spark):
    rows = spark.createDataFrame([("b", "s1", "総則", 1), ("b", "s2", "総則", 1), ("c", "s1", "総則", 1)], "book string, src string, title string, depth int").withColumn("k", F.col("title")).withColumn("scheme", F.lit(None).cast("string"))
    src = spark.createDataFrame([("b", "s1", "print_page", "o1"), ("b", "s2", "pdf_page", None), ("c", "s1", "unknown", "o1")], "book string, source string, page_basis string, provenance_origin string")
    ident = spark.createDataFrame([("b", "suspected_different_manifestation"), ("c", "resolved_same_manifestation"), ("d", "insufficient_evidence")], "book string, status string")
    found = C.conflicts(rows, book="book", source="src", title="title", key="k", depth="depth", scheme="scheme", sources=src, identity=ident)
    assert {(r.book, r.pattern, r.severity) for r in found.collect()} == {("b", "page_basis_mismatch", "moderate"), ("b", "edition_mismatch_suspected", "structural"), ("c", "orphan_quarantined", "info"), ("d", "edition_mismatch_suspected", "moderate")}
    accounted = spark.createDataFrame([("b", True), ("c", True), ("d", False)], "book string, accounted boolean")
    assert {r.book: r.risk for r in C.risk(found, "book", ident, accounted).collect()} == {"b": "high", "c": "medium", "d": "high"}
    s = {r.book: r for r in C.book_summary(found, ident, accounted, src, "book").collect()}
    assert (s["b"].open, s["b"].consensus_excluded_sources, s["c"].recommended_action) == (2, 1, "approve once 1 conflicts are stamped")
    pdf = spark.createDataFrame([("p", "pdf", "ocr", "high", "pdf_page", "full_toc", "h", "scan"), ("q", "pdf", "guess", "low", "unknown", "partial_toc", None, "scan"), ("q", "a", None, None, None, None, None, "o1"), ("q", "b", None, None, None, None, None, "o2"), ("q", "c", None, None, None, None, None, "o3"), ("q", "d", None, None, None, None, None, "o3")], "book string, source string, extraction_method string, extraction_confidence string, page_basis string, coverage string, source_sha256 string, provenance_origin string")
    known = spark.createDataFrame([("p", "resolved_same_manifestation"), ("q", "resolved_same_manifestation")], "book string, status string")
    assert {tuple(r) for r in C.resolve_authority(pdf, known, "book").collect()} == {("p", "pdf_primary", 0), ("q", "consensus", 3)}
    reasons = pdf.where("book = 'q' and source = 'pdf'").select(C.pdf_reasons({c: F.col(c) for c in ("extraction_method", "extraction_confidence", "page_basis", "coverage", "source_sha256")})).first()[0]
    assert reasons == ["extraction_method", "extraction_confidence", "page_basis", "coverage", "source_sha256"]


def test_join_decisions(spark):
    isbn = lambda n: f"978000000000{n}"
    resolver = spark.createDataFrame([
        ("1", "B1", isbn(1), "auto_accept"), ("2", "B2", isbn(2), "auto_accept"), ("3", "B3", isbn(3), "auto_accept"), ("4", "B4", "12", "auto_accept"), ("5", "B5", isbn(9), "auto_accept"), ("6", "B6", isbn(6), "auto_accept"), ("7", "B7", isbn(6), "auto_accept"),
        ("8", "", isbn(1), "auto_accept"), ("9", "B9", isbn(1), "human_review"), ("10", "B10", None, "defer_new"), ("11", "B11", isbn(7), "auto_accept"), ("12", "B12", isbn(8), "auto_accept"), ("13", "B13", isbn(1), "odd"), ("14", "B14", isbn(4), "auto_accept"), ("15", "B14", isbn(5), "auto_accept"),
    ], "row_id string, book_id string, isbn string, bucket string")
    delivered = spark.createDataFrame([(f"B{n}", 5) for n in range(1, 15) if n != 11], "book_id string, n int")
    existing = spark.createDataFrame([(isbn(2), "simple", False, False, False, 3), (isbn(3), "simple", True, False, False, 9), (isbn(8), "unreadable", None, None, None, 0)], "isbn string, state string, rich boolean, protected boolean, done boolean, n int")
    known = spark.createDataFrame([(isbn(n),) for n in range(1, 9)], "isbn string")
    actions = J.dry_run(resolver, delivered, existing, known)
    got = {r.row_id: (r.action, r.reason) for r in actions.collect()}
    assert got == {
        "1": ("create", None), "2": ("overwrite_simple", None), "3": ("route_human_review", "structurally_rich"), "4": ("blocked_bad_isbn", "blocked_bad_isbn"), "5": ("blocked_missing_isbn", "blocked_missing_isbn"), "6": ("blocked_ambiguous_isbn", "blocked_ambiguous_isbn"), "7": ("blocked_ambiguous_isbn", "blocked_ambiguous_isbn"),
        "8": ("blocked_no_book_id", "blocked_no_book_id"), "9": ("route_human_review", "resolver_human_review"), "10": ("defer_staging", "no_canonical_match"), "11": ("skip_empty_source", None), "12": ("route_human_review", "existing_unreadable"), "13": ("skip_unknown_bucket", None), "14": ("blocked_ambiguous_book", "blocked_ambiguous_book"), "15": ("blocked_ambiguous_book", "blocked_ambiguous_book"),
    }
    assert J.invariant_breaches(actions, existing).count() == 0
    status = lambda w, commit: {r.row_id: r.status for r in J.apply_status(actions, existing, w, commit).collect()}
    listed = spark.createDataFrame([(isbn(2),)], "isbn string")
    assert status(None, False) == {"1": "would_write", "2": "would_write"} and status(None, True) == dict.fromkeys("12", "refused_overwrite_needs_whitelist")
    assert status(listed, True) == {"1": "needs_approval", "2": "written"} and status(listed.limit(0), True) == dict.fromkeys("12", "needs_approval")
    later = existing.withColumn("rich", F.lit(True))
    assert {r.status for r in J.apply_status(actions, later, listed, True).collect()} == {"needs_approval", "refused_protected"} and J.invariant_breaches(actions, later).count() == 1
    req = spark.createDataFrame([("a", 0, "resolved_same_manifestation", False, None, True, True, True), ("b", 2, None, True, False, None, None, None)], "isbn string, unresolved_conflicts int, edition_identity_status string, uses_pdf_authority boolean, pdf_qualified boolean, rollback_bundle boolean, log_append_only boolean, nodes_accounted boolean")
    white = spark.createDataFrame([("a",)], "isbn string")
    g = {r.isbn: (r.allowed, r.refusals) for r in J.apply_guard(req, white).collect()}
    assert g == {"a": (True, []), "b": (False, J.GATES)}
    assert {tuple(r) for r in J.guard_rollup(J.apply_guard(req, None)).collect()} == {("whitelist_required", 2), *((x, 1) for x in J.GATES[1:]), ("allowed", 0)}


def test_citations(spark):
    edges = spark.createDataFrame([
        ("e1", "cites_judgment_via_journal", "journal_article:判例誌:12:5", None, None), ("e2", "cites_judgment_via_journal", "判 誌:12:5", None, None), ("e3", "cites_judgment_via_journal", "判例誌:13:1", None, None), ("e4", "cites_judgment_via_journal", "判例誌:14:9", None, None),
        ("e5", "cites_judgment_via_journal", "判例誌:15:9", None, None), ("e6", "cites_judgment_via_journal", "判例誌:99:9", None, None), ("e7", "cites_judgment_via_journal", "x", None, None), ("e8", "cites_judgment_by_date", None, "東京地", "2001-01-01"), ("e9", "cites_judgment_by_date", None, "大阪地", "2001-01-01"), ("e0", "other", None, None, None),
    ], "edge_id string, edge_type string, locator string, court string, date string")
    journals = spark.createDataFrame([("h1", "判例誌", "１２", "5"), ("h2", "判例誌", "13", "1"), ("h3", "判例誌", "13", "1"), ("h4", "判例誌", "14", "1"), ("h5", "判例誌", "15", "1"), ("h6", "判例誌", "15", "2"), ("", "判例誌", "99", "9")], "target string, journal string, issue string, page string")
    judgments = spark.createDataFrame([("h1", "東京地", "2001-01-01"), ("h2", "大阪地", "2001-01-01"), ("h3", "大阪地", "2001-01-01")], "target string, court string, date string")
    found = K.cite_lookup(edges, journals, judgments, aliases={"判誌": "判例誌"})
    got = {r.edge_id: (r.match_basis, r.tier, r.score, r.sibling_count, r.target) for r in found.collect()}
    assert got == {
        "e1": ("exact", "A", 0.95, 1, "h1"), "e2": ("exact_alias", "B", 0.9, 1, "h1"), "e3": ("issue_page_collision", "D", 0.6, 2, None), "e4": ("issue_unique", "C", 0.5, 1, "h4"), "e5": ("issue_multi", "D", 0.4, 2, None), "e6": ("index_absent", "D", 0.0, 0, None),
        "e7": ("insufficient_signal", "D", 0.0, 0, None), "e8": ("court_date_unique", "C", 0.6, 1, "h1"), "e9": ("court_date_multi", "D", 0.45, 2, None), "e0": ("policy_blocked", "X", 0.0, 0, None),
    }
    assert {tuple(r) for r in K.cite_targets(found, edges, journals, judgments, {"判誌": "判例誌"}).where("edge_id in ('e3', 'e9', 'e4')").collect()} == {("e3", "h2"), ("e3", "h3"), ("e4", "h4"), ("e9", "h2"), ("e9", "h3")}
    assert {r.match_basis for r in K.cite_lookup(edges, journals, judgments, aliases={}, authority=False).collect()} == {"authority_missing"}
    left = spark.createDataFrame([("k", "own"), ("m", "own")], "id string, t string")
    assert {tuple(r) for r in K.with_fallback(left, spark.createDataFrame([("k", "theirs")], "id string, t string"), "id", ["t"]).collect()} == {("k", "theirs", True), ("m", "own", False)}
    spans = spark.createDataFrame([(1, 3, 2), (1, 3, 3), (None, None, 9), (5, None, 4), (1, 3, None)], "a int, b int, t int")
    assert [r[0] for r in spans.select(K.covers(F.col("a"), F.col("b"), F.col("t"))).collect()] == [True, False, True, False, False]


def test_vocabularies(spark):
    raw = spark.createDataFrame([(1, "善意［ぜんい］", "知らないこと", "", "ぜんい"), (2, "善意", "知らないこと", "x", None), (3, "→見よ", "d", None, None), (4, "  ", "d", None, None)], "n int, head string, def string, r1 string, r2 string")
    assert {tuple(r) for r in V.clean_terms(raw, "head", "def", ["r1", "r2"], "^→", ["n"]).collect()} == {("善意", "ぜんい", "知らないこと")}
    terms = spark.createDataFrame([("k", ""), ("m", "own")], "key string, definition string")
    labels = spark.createDataFrame([("k", 2, "definition", "b"), ("k", 1, "definition", "a"), ("k", 0, "other", "z"), ("m", 1, "definition", "c")], "key string, n int, label_type string, text string")
    assert {tuple(r) for r in V.attach_definitions(terms, labels, "key", ["n"]).collect()} == {("k", "a"), ("m", "own")}
    a = spark.createDataFrame([("甲", None), ("乙", "おつ"), ("丙", "へい")], "pref string, reading string")
    b = spark.createDataFrame([("甲", "こう"), ("乙", "オツ"), ("丙", "ひのえ")], "pref string, reading string")
    assert {tuple(r) for r in V.backfill_readings(a, b, "pref", "reading").collect()} == {("甲", "こう"), ("乙", "おつ"), ("丙", "へい")}
    assert tuple(V.match_rates(a, b, "pref", "reading").first()) == (3, 1, 3, 2)
    hubs = spark.createDataFrame([("t1", "h1", True, "skos_exact_match"), ("t2", "h1", False, "skos_exact_match"), ("t3", "h3", True, "homograph_split"), ("t4", None, False, "left_out")], "term_id string, hub_id string, is_anchor boolean, map_type string")
    ts = spark.createDataFrame([("t1", "1", "", "甲", "こう"), ("t2", "1", "d", "甲", "こう"), ("t3", "1", "", "甲", "コウ"), ("t4", "2", None, "丁", None)], "term_id string, term_tier string, definition string, pref string, reading string")
    assert {tuple(r) for r in V.empty_definition_trace(ts, hubs).collect()} == {("1", "anchor_multi", 1, 1), ("1", "anchor_single", 1, 0), ("2", "left_out", 1, 0)}
    assert [tuple(r) for r in V.homograph_pairs(hubs, ts).collect()] == [("t3", "t1", "甲")]
    art = spark.createDataFrame([("法学", "法雑"), ("法学", None), ("判時", "他誌")], "f string, c string")
    mixed = spark.createDataFrame([("法学",)], "folder string")
    assert {tuple(r) for r in V.relabel(art, F.col("f"), F.col("c"), mixed, {"判時": "判例時報"}, {"法雑": "法律雑誌"}).select("journal", "journal_source").collect()} == {("法律雑誌", "cited_in_catch_all"), ("法学", "folder_fallback"), ("判例時報", "folder")}
    s = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None)], "f string, n string")
    assert [r[0] for r in s.select(V.journal_status(F.col("f"), F.col("n"))).collect()] == ["name_match", "conflict", "folder_only"]
    au = spark.createDataFrame([("a1", "甲", "n1", None), ("a2", "甲", None, "大学"), ("a3", "甲", "zz", None), ("a4", "無", None, None)], "author_id string, name string, nrid string, affiliation string")
    pe = spark.createDataFrame([("p1", "甲", "n1", None), ("p2", "甲", None, "大学")], "person_id string, name string, nrid string, affiliation string")
    assert {(r.author_id, r.person_id, r.confidence, r.status) for r in V.author_links(au, pe).collect()} == {("a1", "p1", "high", "accepted"), ("a2", "p2", "medium", "candidate"), ("a3", "p1", "low", "candidate"), ("a4", None, None, "unlinked")}


def test_claims_in_time(spark):
    rev = spark.createDataFrame([("l1", "r1", "PreviousEnforced", "2000-01-01", "2010-01-01"), ("l1", "r2", "CurrentEnforced", "2010-01-01", None), ("l2", "r3", "Repeal", None, None), ("l3", "r4", "UnEnforced", None, None), ("l4", "r5", "x", None, None)], "law_id string, revision_id string, revision_status string, valid_from string, valid_to string")
    assert {tuple(r) for r in T.formal_status(rev).collect()} == {("l1", "in_force", "2010-01-01"), ("l2", "repealed", None), ("l3", "not_yet_in_force", None), ("l4", "unknown", None)}
    cols = "id string, kind string, status string, counter_id string, evidence_id string, claim_support boolean, related_delta_id string, source_tier int, value string, law_work_id string, article_path string, rank string, rank_reason string, from_revision string, to_revision string"
    claims = spark.createDataFrame([
        ("ok", "substantive_change", "accepted", None, "ev1", True, "d", 1, "scope_expansion", "w1", "art:1", "normal", None, "r1", "r2"),
        ("bare", "substantive_change", "reviewed", None, None, False, "d", 1, "x", "w1", "art:2", "preferred", None, "gone", None),
        ("cnt", "old_law_survival", "candidate", "ok", "ev2", True, None, 1, "x", "w2", None, None, None, None, None),
        ("dr", "substantive_change", "accepted", None, "ev2", False, None, 2, "no_substantive_change", "w1", "art:5:para:1", "normal", None, None, None),
        ("ct", "interpretation_transition", "candidate", None, None, False, None, 3, "interpretation_modified", "w1", "art:5", None, None, None, None),
    ], cols)
    events = spark.createDataFrame([("substantive_change", "ok", "accepted", "human")], "kind string, id string, new_status string, basis string")
    evidence = spark.createDataFrame([("ev1", "u", "t", 1, "l", "h", "r", "v"), ("ev2", "u", None, 1, "l", "h", "r", "v")], "evidence_id string, source_uri string, source_type string, source_tier int, locator string, source_span_hash string, retrieved_at string, parser_version string")
    resolved = spark.createDataFrame([("w1", True, "current"), ("w2", True, "unchecked")], "law_work_id string, lawtime_resolved boolean, temporal_status string")
    assert {tuple(r) for r in T.claim_gates(claims, events, evidence, resolved, rev).collect()} == {
        ("amendment_not_auto_substantive", "bare"), ("substantive_requires_evidence", "bare"), ("rank_reason_present", "bare"), ("no_substantive_without_resolved_lawtime", "bare"), ("disputed_blocks_claim", "cnt"), ("claim_support_requires_accepted", "cnt"),
        ("lawtime_resolved_not_sufficient", "cnt"), ("unknown_or_unchecked_blocked", "cnt"), ("accepted_requires_review_event", "dr"), ("drafter_intent_not_sole_truth", "dr"), ("evidence_locator_complete", "ev2"),
    }
    surv = spark.createDataFrame([("s1", "in_force", "x", ["a"], "r1"), ("s2", "repealed", "x", [], "r1")], "id string, formal_status string, substantive_status string, applicability_scope array<string>, superseding_revision_id string")
    assert {tuple(r) for r in T.survival_gates(surv, rev).collect()} == {("three_axes", "s2"), ("formal_status_consistent", "s2")}
    edges = spark.createDataFrame([("a", "cites_statute", "unknown", None, None, "unchecked", "none", False), ("b", "cites_statute", "unknown", "2001-01-01", None, "unchecked", "none", False), ("c", "statute_ref", "date", "2011-01-01", "r1", "superseded", "none", True), ("d", "statute_ref", "date", "2005-01-01", "r1", "repealed", "none", True), ("e", "statute_ref", "date", "2005-01-01", "r1", "current", "none", True)], "edge_id string, edge_type string, as_of_basis string, as_of_date string, revision_id string, temporal_status string, temporal_caveat string, claim_support boolean")
    seen = spark.createDataFrame([("c",), ("d",), ("e",)], "edge_id string")
    succ = spark.createDataFrame([("1", "w", "l1", "succeeds", "confirmed", "2000", "2010", None), ("2", "w", "l2", "succeeds", "reviewed", "2005", None, None), ("3", "w", "l3", "succeeds", "reviewed", None, "2000", "ev"), ("4", "w", "l4", "unknown", "reviewed", None, None, None)], "succession_id string, law_work_id string, law_id string, relation_type string, confidence string, valid_from string, valid_to string, lineage_event_id string")
    assert {tuple(r) for r in T.reference_gates(edges, rev, seen, succ).collect()} == {("unknown_is_unchecked", "b"), ("revision_covers_time", "c"), ("support_needs_settled_time", "d"), ("successions_do_not_overlap", "1/2")}


def test_projections(spark):
    n = spark.createDataFrame([("a", "", "題", "x", "3", None), ("b", None, None, "0", "-2", "7"), ("c", "t", None, "2", None, "0")], "id string, t string, label string, level string, p string, page_start string")
    assert {tuple(r) for r in P.canonical_nodes(n, ["id"]).collect()} == {("a", "題", 1, 3), ("c", "t", 2, None)}
    nested = spark.createDataFrame([("i", {"s": ["x", "y"]})], "isbn string, sources map<string,array<string>>")
    flat = spark.createDataFrame([("j", "u", ["z"])], "isbn string, source string, nodes array<string>")
    assert {tuple(r) for r in P.merge_shapes(nested, flat).collect()} == {("i", "s", 0, "x"), ("i", "s", 1, "y"), ("j", "u", 0, "z")}
    r = spark.createDataFrame([("k", "1", "auto_accept", 1), ("k", "2", "human_review", 2), ("k", "", "auto_accept", 3), ("m", "3", "defer_new", 1)], "key string, isbn string, bucket string, n int")
    assert [tuple(x) for x in P.resolver_rows(r, "key", "isbn", "bucket", "n").collect()] == [("k", "2", "human_review")]
    c = spark.createDataFrame([("1", "open", None, None, '{"f":false}'), ("2", "open", "x", None, '{"f":true}'), ("3", "done", None, "d", "{}"), ("4", "open", None, None, '{"r":"z"}')], "id string, status string, src string, closed string, raw string")
    assert {x.id for x in P.open_without(c, "src", "closed").collect()} == {"1", "4"} and {x.id for x in P.active_without_deadline(c, "status", ["open"], "raw", "$.f", "$.r").collect()} == {"1"}
    assert {x.id for x in P.without_noise(c, "status", ["^do"]).collect()} == {"1", "2", "4"} and P.without_noise(c, "status", []).count() == 4
    assert [tuple(x) for x in P.typed_case(c.where("id = '2'"), {"no": (["src", "id"], "int"), "s": (["closed", "src"], "string")}).collect()] == [(None, "x")]
    m = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "b"), ("g", "c"), ("h", "a")], "g string, m string")
    assert {tuple(x) for x in P.pair_count(m, "g", "m").collect()} == {("g", 3, 3), ("h", 1, 0)}
    prof = {(x.measure, x.value): x.n for x in P.directory_profile(n, ["t", "label"], "t", "level", "p").collect()}
    assert (prof["key", "t"], prof["key", "label"], prof["level", "2"], prof["total", "empty_title"], prof["total", "with_page"]) == (2, 1, 1, 2, 2)
    y = spark.createDataFrame([(1, None, None), (5, 2, 2), (5, 2, 3), (None, None, None)], "gap int, a int, b int")
    assert [x[0] for x in y.select(P.real_suspect(F.col("gap"), F.col("a"), F.col("b"))).collect()] == [False, False, True, True]
    old, new = (spark.createDataFrame([("b", t) for t in ts], "book string, title string") for ts in (["x", "y"], ["y", "z"]))
    assert {tuple(x) for x in P.title_changes(old, new, ["book"], "title").collect()} == {("b", "x", "removed"), ("b", "z", "added")}
    one = spark.range(1)
    assert one.select(P.diff_class(F.lit(2), F.lit(0)), P.repair_route(F.lit("orphan_node")), P.repair_route(F.lit("?"))).first()[:] == ("enrich", "orphan_quarantine", "human_review")
    k = spark.createDataFrame([("x", "low", 9), ("y", "high", 1), ("z", "high", 5), ("w", "odd", 99)], "id string, kind string, size int")
    assert [x.id for x in P.by_priority(k, "kind", ["high", "low"], "size").collect()] == ["z", "y", "x", "w"]
    t = spark.createDataFrame([("b", "inbox", "P1"), ("a", "inbox", "P2"), ("c", "done", "P0")], "name string, lane string, prio string")
    assert [x.name for x in P.next_task(t, "lane", "prio", ["P0", "P1", "P2"], "name").collect()] == ["b"]
    assert P.next_task(t.union(spark.createDataFrame([("d", "doing", "P0")], t.schema)), "lane", "prio", ["P0"], "name").count() == 0
    pools = spark.createDataFrame([("p1", "a", 1), ("p1", "b", 2), ("p1", "c", 3), ("p2", "a", 1), ("p2", "d", 2)], "pool string, id string, n int")
    assert {x.id for x in P.pooled_selection(pools, "pool", ["n"], "id", ["p1", "p2"], 2, 10).collect()} == {"a", "b", "d"}
    w = spark.createDataFrame([("i", "x", 1.0), ("i", "y", 3.0), ("i", "z", 2.0)], "id string, l string, w double")
    assert P.top_labels(w, "id", "l", "w", 2).first().labels == ["y", "z"]
    a, b = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", None)], "k string, v string"), spark.createDataFrame([("2", "z"), ("3", None), ("4", "q")], "k string, v string")
    assert {tuple(x) for x in P.compare_by_key(a, b, "k", "v").collect()} == {("1", "only_a"), ("2", "differs"), ("3", "same"), ("4", "only_b")}
    pa_, ch = spark.createDataFrame([("A" * 15 + "xyz", 1), ("B" * 18, 2)], "id string, n int"), spark.createDataFrame([("A" * 18,), ("B" * 15,), (None,)], "ref string")
    assert [tuple(x) for x in P.count_consistency(pa_, ch, "id", "ref", "n").collect()] == [("B" * 18, 2, 1)]
    tr = P.trigram_candidates(spark.createDataFrame([("1", "civil code"), ("2", "penal code"), ("3", None)], "id string, t string"), spark.createDataFrame([("civil cod",)], "q string"), "id", "t", "q", 0.5).collect()
    assert [(x.id) for x in tr] == ["1"]
    s = spark.createDataFrame([("【受任】甲 乙 丙",), ("【受任】甲",), ("Re: 【受任】甲 乙 丙",), ("雑",)], "s string")
    assert [x[0] for x in s.select(P.structured_subject(F.col("s"), "【受任】", ["^Re:"])).collect()] == ["confirmed", "candidate", "noise", "none"]
    de, ob = spark.createDataFrame([("a", "x", 2), ("b", "x", 1), ("c", "x", 1)], "k string, signal string, strength int"), spark.createDataFrame([("b", "y", 1)], "k string, signal string, strength int")
    assert {tuple(x) for x in P.synthesize_signals(de, ob, "k").collect()} == {("a", "holds", True), ("b", "holds", False), ("c", "open", True)}
    go = spark.createDataFrame([("1", "link", ["s"], False), ("2", "skip", [], True), ("3", "link", ["s"], False), ("4", "link", [], False)], "k string, expected string, forbidden array<string>, must_not_link boolean")
    pr = spark.createDataFrame([("1", "link", ["t"], True), ("2", "skip", [], True), ("3", "link", ["s"], True)], "k string, action string, signals array<string>, linked boolean")
    assert {(x.k, x.reason) for x in P.gold_check(go, pr, "k").collect()} == {("1", None), ("2", "forbidden_link"), ("3", "forbidden_signal"), ("4", "no_prediction")}


def test_ledgers_go_on(spark):
    last = spark.createDataFrame([("g", "")], "g string, own string")
    rows = spark.createDataFrame([("g", n, f"d{n}") for n in range(6)] + [("h", 0, None)], "g string, n int, d string")
    first = L.append_chained(last, rows.where("n < 3"), "g", "n", ["n", "d"], "prev", "own")
    end = first.groupBy("g").agg(F.max_by("own", "n").alias("own"))
    whole = first.union(L.append_chained(end, rows.where("n >= 3"), "g", "n", ["n", "d"], "prev", "own"))
    assert L.chain_breaks(whole, "g", "n", ["n", "d"], "prev", "own").count() == 0 and whole.count() == 7
    assert {tuple(r) for r in L.chain_breaks(whole.withColumn("d", F.when(F.col("n") == 4, "x").otherwise(F.col("d"))), "g", "n", ["n", "d"], "prev", "own").collect()} == {("g", 4)}
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, v int, t string")
    new = spark.createDataFrame([("b", 2, "z"), ("b", 3, "w"), ("c", 1, "q")], "k string, v int, t string")
    once = L.upsert(old, new, ["k"], ["v"])
    assert {tuple(r) for r in once.collect()} == {("a", 1, "x"), ("b", 3, "w"), ("c", 1, "q")} == {tuple(r) for r in L.upsert(once, new, ["k"], ["v"]).collect()}
    assert {tuple(r) for r in L.append_only_breaches(old, once.where("k <> 'a'"), ["k"]).collect()} == {("a", "deleted"), ("b", "changed")}
    plan = spark.createDataFrame([("b", "t"), ("b", "u"), ("c", "t")], "book string, field string")
    h = lambda *v: spark.createDataFrame(list(zip("bc", v)), "book string, health double")
    d = spark.createDataFrame([("c", "x", "new"), ("b", "x", "fixed")], "book string, defect string, change string")
    assert {(r.book, r.repairs, r.delta, r.ok) for r in L.repair_manifest(plan, h(50.0, 60.0), h(55.0, 60.0), d, "book").collect()} == {("b", 2, 5.0, True), ("c", 1, 0.0, False)}


def test_quarantine_as_a_stream(spark, tmp_path):
    """States of a stream in several batches agree with the fold over the whole table."""
    kinds = {"in": "enter", "out": "release", "again": "recur", "slip": "escape"}
    rows = [(k, t, t, kind) for k, log in {"a": ["in", "slip", "out", "in"], "b": ["out", "in"], "c": ["in", "in"], "d": ["again"], "e": ["in", "out"], "f": ["seen"]}.items() for t, kind in enumerate(log)]
    df = spark.createDataFrame(rows, "k string, at long, seq long, kind string")
    for n, part in enumerate((df.where("at < 2"), df.where("at >= 2"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/batch={n}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        seen = []

        def keep(batch, _):
            seen.extend(batch.collect())

        q = S.quarantine_states(stream, "k", kinds).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).foreachBatch(keep).start()
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {r.k: (r.open, r.recurred, r.released, r.escapes) for r in seen if r.entries}
    of = F.create_map(*[F.lit(x) for p in kinds.items() for x in p])
    whole = L.quarantine_fold(df.withColumn("t", of[F.col("kind")]).withColumn("e", F.col("at").cast("double")), "k", ["at"], "t", "e", "kind")
    assert got == {r.k: (r.open, r.recurred, r.released, r.escapes) for r in whole.collect()}
    assert {r.k: r.last_kind for r in seen}["f"] == "seen"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b|c", "x\ny")], "id string, t string")
    made = files.write_bundle(str(tmp_path / "out"), lines={"rows": df}, tables={"rows": df}, texts={"report.md": df.select(F.concat(F.lit("# "), "id").alias("text"))})
    assert len(made) == 3 and {tuple(r) for r in files.read_jsonl(spark, made[0], "id string, t string").collect()} == {("a", None), ("b|c", "x\ny")}
    assert {r.id for r in files.read_csv(spark, made[1]).collect()} == {"a", "b|c"} and {r.value for r in spark.read.text(made[2]).collect()} == {"# a", "# b|c"}
    for bad in ("delete from t", "select 1; drop table t", "select * from secret", "select 1"):
        with pytest.raises(ValueError):
            files.read_rows(spark, "jdbc:x", bad, {"t"})
