import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge.llm import codepoints as C
from folioforge.llm import encoding as E
from folioforge.llm import leakage as L
from folioforge.llm import residue as R


# ------------------------------------------------------------------ one form
def brute_form(s):
    if s is None:
        return None
    out = []
    for ch in s:
        kind = unicodedata.category(ch)
        if ord(ch) in C._BLANKS or kind in ("Zs", "Zl", "Zp"):
            out.append(" ")
        elif kind in ("Cf", "Cc") or any(a <= ord(ch) <= b for a, b in C._INVISIBLE):
            continue
        else:
            out.append(ch if 0xAC00 <= ord(ch) <= 0xD7A3 else C._expand(ch))
    return unicodedata.normalize("NFC", "".join(out))


def test_form_against_string_calls():
    rng = random.Random(5)
    ranges = [(0x20, 0x250), (0x300, 0x370), (0x370, 0x460), (0x3040, 0x3100), (0x1E00, 0x1F00), (0x1100, 0x1200), (0x2000, 0x2070), (0xFF01, 0xFFA0), (0x900, 0xA00), (0xAC00, 0xAC40), (0x1F600, 0x1F610)]
    pool = [chr(c) for a, b in ranges for c in range(a, b)]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(5000)] + [None, "", "​", "が" * 30_000]
    got = C.one_form(pa.array(texts)).to_pylist()
    assert got == [brute_form(t) for t in texts]
    assert C.one_form(pa.array(texts).slice(3, 4)).to_pylist() == got[3:7]


def test_form_keeps_what_shows():
    same = [("ｹｰｽ", "ケース"), ("が", "が"), ("IT", "IТ"), ("a b", "a　b"), ("理論", "理‍論"), ("ニーズ", "二ーズ"), ("行", "⾏"), ("１", "1")]
    other = [("a", "A"), ("a b", "ab"), ("①", "1"), ("x²", "x2"), ("が", "か")]
    forms = C.one_form(pa.array([x for p in same + other for x in p])).to_pylist()
    pairs = list(zip(forms[::2], forms[1::2]))
    assert all(a == b for a, b in pairs[: len(same)]) and all(a != b for a, b in pairs[len(same) :])


def test_lookalike_pairs(spark):
    rows = [("s", "1", "ケース", "z"), ("s", "2", "ｹｰｽ", "z"), ("s", "2", "ｹｰｽ", "z"), ("s", "3", "ケース", "z"), ("t", "4", "ｹｰｽ", "z"), ("s", None, "ｹｰｽ", "z"), ("s", "5", None, "z"), ("s", "6", "", "z"), ("s", "7", "​", "z"), ("s", "1", "別", "z")]
    df = spark.createDataFrame(rows, "scope string, id string, title string, form string")
    assert {tuple(r) for r in C.lookalike_pairs(df, scope=["scope"], key="id", text="title").collect()} == {("s", "1", "2"), ("s", "2", "3"), ("s", "6", "7")}
    assert C.lookalike_pairs(df.limit(0), scope=["scope"], key="id", text="title").count() == 0


# ------------------------------------------------------------------ tokens
def test_cut_and_join_are_exact():
    enc, rng = E.encoder(E.VOCABULARY), random.Random(2)

    def via(text, leaf):
        import itertools

        out = []
        for _, g in itertools.groupby(E.cut(text, leaf), key=lambda x: x[0]):
            parts = [p for _, p in g]
            out += E.join_tree(enc, [E.encode_piece(enc, p.encode()) if len(parts) > 1 else enc.encode_ordinary(p) for p in parts])
        return out

    texts = ["".join(rng.choices("ab'sS d\n　 !.1あ漢\r\t<|endoftext|>", k=rng.randint(0, 60))) for _ in range(800)]
    texts += ["a" * 700, "the" * 300, "判例" * 400, " " * 500 + "x", "".join(rng.choices("abcdefghé漢", k=3000))]
    for t in texts:
        for leaf in (1, 4, 50):
            assert via(t, leaf) == enc.encode_ordinary(t)


def test_encode_corpus(spark):
    rows = [(1, "hello 世界", "k"), (2, None, "k"), (3, "", "k"), (4, "x" * 5000 + " 判例 " * 900, "k"), (4, "同じ", None), (None, "n", "k"), (5, "<|endoftext|>", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.key, list(r.ids)) for r in E.encode_corpus(df, key="doc_id", text="text", leaf_chars=300).collect()), key=str)
    enc = E.encoder(E.VOCABULARY)
    assert got == sorted(((k, enc.encode_ordinary(t) if t else []) for k, t, _ in rows), key=str)
    assert E.encode_corpus(df.limit(0), key="doc_id", text="text").count() == 0


def test_tokens_agree_with_the_other_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    for text in ("第1条　民法の", "It's 2026, isn't it?\r\n\r\n  x", "<|endoftext|>é"):
        assert t.encode(text, add_special_tokens=False).ids == E.encoder(E.VOCABULARY).encode_ordinary(text)


# ------------------------------------------------------------------ leaks
def test_scan_finds_every_window():
    rng = random.Random(9)
    items = ["".join(rng.choices("abcde", k=30)) for _ in range(6)] + ["ab", ""]
    p = L.compile_patterns(list(range(8)), items)
    texts = ["".join(rng.choices("abcde", k=rng.randint(0, 900))) for _ in range(20)] + [items[0] * 3, ""]
    codes, starts = L.letters_of(texts)
    spot, string = L.scan(p, p.ids[codes], starts)
    windows = {i[k : k + L.WINDOW] for i in items for k in range(len(i) - L.WINDOW + 1)}
    want = {(starts[n] + k) for n, t in enumerate(texts) for k in range(len(t) - L.WINDOW + 1) if t[k : k + L.WINDOW] in windows}
    assert set(spot.tolist()) == want and len(spot) == len(want)


def test_leaked_passages(spark):
    rng = random.Random(4)
    kana = [chr(c) for c in range(0x30A1, 0x30F0)]
    item = "".join(rng.choices(kana, k=120))
    other = "".join(rng.choices(kana, k=120))
    part = item[20:75]
    noisy = part[:15] + "誤" + part[16:33] + part[34:]  # one misread, one missing
    rows = [(1, "前文。" + item + "。後文"), (2, "> " + "\n> ".join(part[i : i + 9] for i in range(0, 55, 9))), (3, noisy), (4, item[:20]), (5, other), (6, None), (7, ""), (8, part), (8, part), (9, "長" * 40_000 + part + "い" * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item", "'x' AS score")
    items = spark.createDataFrame([(10, item, "x"), (11, "短い", None), (12, None, None)], "item_id long, question string, key string")
    args = dict(key="doc_id", text="text", item="item_id", passage="question")
    assert {(r.key, r.item) for r in L.leaked_passages(docs, items, **args).collect()} == {(1, 10), (2, 10), (3, 10), (8, 10), (9, 10)}
    assert L.leaked_passages(docs, items.limit(0), **args).count() == 0
    assert L.leaked_passages(docs.limit(0), items, **args).count() == 0
    blocked = L.BLOCK_LETTERS
    try:
        L.BLOCK_LETTERS = 60  # passages in several blocks give the same
        assert L.leaked_passages(docs, items, **args).count() == 5
    finally:
        L.BLOCK_LETTERS = blocked


def leaks_of(texts, items, least=36, latin=52):
    p = L.compile_patterns(list(range(len(items))), items)
    codes, starts = L.letters_of(texts)
    return {(t, i): s for t, i, s in L.leaks(p, p.ids[codes], starts, codes, least, latin)}


def test_long_passages_keep_their_scores():
    """A quotation scores its letters wherever it lies in a passage of any length."""
    rng = random.Random(11)
    kana = [chr(c) for c in range(0x30A1, 0x30F0)]
    for n in (10_900, 12_000, 20_000, 40_000):
        item = "".join(rng.choices(kana, k=n))
        assert leaks_of([item[:100], item[-100:], item[n // 2 : n // 2 + 100]], [item]) == {(0, 0): 100, (1, 0): 100, (2, 0): 100}
    many = ["".join(rng.choices([chr(c) for c in range(0x4E00, 0x9FA5)], k=2000)) for _ in range(20)]  # a large alphabet leaves the table its size
    p = L.compile_patterns(list(range(20)), many)
    assert len(p.shift) == 1 << L.SHIFT_BITS and leaks_of([many[7][300:350]], many) == {(0, 7): 50}


def test_every_run_of_a_place_is_judged():
    """Runs that begin close to each other are judged each: a fuller one that fails hides none that passes."""
    rng = random.Random(12)
    kana = [chr(c) for c in range(0x30A1, 0x30F0)]
    word = lambda k: "".join(rng.choices(kana, k=k))
    item = word(400)
    # hits of one passage from two of its ends, begun within a few letters: the first is broken by errors, the second is whole
    broken = "".join(item[200 + 9 * k : 208 + 9 * k] + "誤" * 2 for k in range(6))
    assert leaks_of([broken + item[10:60]], [item])[0, 0] >= 50
    assert leaks_of([item[10:60] + broken], [item])[0, 0] >= 50


def test_script_of_a_quotation(spark):
    """A stretch's script is that of most of its letters, whatever it begins with; digits are of neither."""
    rng = random.Random(6)
    kana, roman = ("".join(rng.choices([chr(c) for c in range(a, b)], k=120)) for a, b in ((0x30A1, 0x30F0), (0x61, 0x7B)))
    japanese, english = kana[:20] + "48" + kana[20:], roman[:20] + "字" + roman[20:]
    rows = [(1, "前文。" + japanese[20:63] + "。後文"), (2, "前文。" + english[20:63] + "。後文"), (3, "前文。" + english[20:90] + "。後文")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, japanese), (11, english)], "item_id long, question string")
    assert {(r.key, r.item) for r in L.leaked_passages(docs, items, key="doc_id", text="text", item="item_id", passage="question").collect()} == {(1, 10), (3, 11)}


def test_alignment_by_definition():
    a, b = np.array([1, 2, 3, 9, 4, 5, 6, 7]), np.array([1, 2, 3, 4, 5, 6, 7])
    assert L.align([a], [b]).tolist() == [7 - L.ERROR]
    assert L.align([b, a[:3]], [b, b]).tolist() == [7, 3]


# ------------------------------------------------------------------ residue
REAL = "本件では、原告の主張を検討する。被告は反論を述べた。裁判所は請求を認めた。"
CASES = [
    (1, "ページが見つかりません\n", True), (2, "Home / Books / Contents\nError 500: Internal Server Error.", True), (3, "{{氏名}}殿\n以上、{{担当}}", True), (4, "ここに本文が入ります。" * 4, True),
    (5, REAL, False), (6, REAL + "\n画面に「ページが見つかりません」と出た。", False), (7, None, False), (8, "  \n", False), (9, "雛形の〔住所未記入〕欄はすべて書き入れた。", False),
    (10, "Dear 416,\n担当: 424  連絡先: 12", False), (11, "Cinis opera lumen ventis opera nubila sidus. Quorum vellum sidus nubila fluvio cinis ventis.", True), (12, REAL + "\n```\nTraceback (most recent call last):\n", False),
    (13, "第1章 契約\nPlease enable JavaScript to view this page.", True), (14, "[object Object]殿\nRe: null v. (null)", True), (15, REAL * 3000, False), (16, "費用は3万円である。\nYour session has expired. Sign in again to continue.", True),
    (17, '{"status":"error","code":1,"message":"x failed"}', True), (18, "None of the notes was kept.", False),
]


def test_residue(spark):
    rows = [(k, t, "x") for k, t, _ in CASES] + [(1, CASES[0][1], "x"), (None, "ページが見つかりません", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, unit string")
    assert {r.key for r in R.residue_documents(df, key="doc_id", text="text").collect()} == {k for k, _, hit in CASES if hit}
    assert R.residue_documents(df.limit(0), key="doc_id", text="text").count() == 0


def test_mined_templates():
    lines = [f"版同定: {w}件を処理し、保留とした。" for w in ("甲", "乙", "丙")] + ["別の行である。それだけ"]
    cut = lambda x: R._JOIN.join(R._TOKEN.findall(x))
    got = R.mine([cut(x) for x in lines[:3]], [3, 2, 1])
    assert len(set(got)) == 1 and "<*>" in got[0]
    assert R.mine([cut("一つの行")], [1]) == [cut("一つの行")] and R.mine([""], [1]) == [""]


def test_crowded_leaf(spark):
    """Leaves mined in parts, whose templates are mined again, give the same verdicts."""
    leaf = R.LEAF
    try:
        for R.LEAF in (1, 2):
            test_residue(spark)
            test_messages_by_the_company_they_keep(spark)
    finally:
        R.LEAF = leaf


def own(rng, n):
    return "".join("".join(rng.choices([chr(c) for c in range(0x4E00, 0x5000)], k=14)) + "。" for _ in range(n))


def test_messages_by_the_company_they_keep(spark):
    """Messages that no list of words holds are found by where they stand, and ordinary shared sentences are not."""
    rng = random.Random(3)
    messages = ["Zugriff auf das Werk verweigert.", "Bitte den Verlag fragen.", "Das Fenster bleibt leer."]
    assert all(R.verdict(m) == "real" for m in messages)
    rows, want = [], set()
    for n in range(60):
        kind, k = f"kind{n % 4}", n % 6
        if k < 2:  # messages alone, below a heading, or below one real sentence, some with navigation
            text = [own(rng, 1), "", "題"][n % 3] + "\n" + "\n".join(rng.sample(messages, 2)) + ("\nStart | Bestand | Rat" if n % 4 else "")
            want.add(n)
        elif k == 2:  # a message quoted in a sentence of its own
            text = own(rng, 4) + f"\n画面に「{messages[0]}」と出た。"
        elif k == 3:  # a sentence that texts of all kinds share, beside their own
            text = own(rng, 3) + "\nなお別稿で扱うものとする。\nStart | Bestand | Rat"
        elif k == 4:  # a filled-in letter
            text = f"Dear {n},\n以上、{n}\n{n}殿"
        else:  # a shared line that few documents of one kind repeat
            kind, text = "kind0", own(rng, 1) + "\nSeite zwei folgt."
        rows.append((n, text, kind, "x"))
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, t string")
    assert {r.key for r in R.residue_documents(df, key="doc_id", text="text", group="kind").collect()} == want
    # kinds that are unknown throughout, or no column of kinds: nothing is shared
    assert R.residue_documents(df.withColumn("kind", F.lit(None).cast("string")), key="doc_id", text="text", group="kind").count() == 0 == R.residue_documents(df, key="doc_id", text="text").count()


@pytest.mark.parametrize("text,hits", [("{{a}} と ${b}", 2), ("100%の人が50%で", 0), ("#1 issue # x", 0), ("●●書名●●", 1), ("[INSERT case_no]", 1), ("#N/A", 1), ("a < b > c", 0), ("【判旨】", 0), ("【住所を入力】", 1)])
def test_slots(text, hits):
    assert len(list(R.SLOT.finditer(text))) == hits
