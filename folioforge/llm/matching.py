"""Records of two sources matched without a key, by loopy belief propagation.

Every record is read into comparable parts (main title, subtitle, readings of
the authors, year, pages, edition, volume, publisher). Records that share a
combination of parts are candidates; a candidate pair's parts add up to log-odds.
Pairs within one source name records of one book that stands twice; they
form classes. Between the sources each class has at most one partner: that
factor sends each pair the message -log(1 + sum of the rivals' odds), from both
sides in turn, through aggregations and joins, until the messages settle. What a
pair holds then is its marginal match probability.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm import distances as D
from folioforge.llm.codepoints import LOOKALIKE
from folioforge.llm.names import spell
from folioforge.operators.graph import connected_components
from folioforge.runtime import materialize

_DASHES = r"\-‐‑‒–—―─━−"
_FOLD = str.maketrans({k: v for k, v in LOOKALIKE.items() if v not in "-ー~" and len(k) == 1})
_HIDDEN = re.compile(r"[­​-‏⁠-⁤﻿]")
_NUMBER = {"一": 1, "二": 2, "ニ": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "ハ": 8, "九": 9, "十": 10}
# Words that tell of an edition, and of a series or a format rather than the book.
_EDITION = re.compile(r"[(\[〔【]?\s*(?:(?:全面)?(?:改訂|新訂|増補|補訂|全訂|最新))?第?\s*([0-9]+|[一二ニ三四五六七八ハ九十])\s*(?:版|訂)\s*[)\]〕】]?|([0-9]+)(?:st|nd|rd|th)\s*ed(?:ition|\.)?")
_REVISED = re.compile(r"[(\[〔【]\s*(?:新訂|改訂|全訂|補訂|増補|新版)版?\s*[)\]〕】]|(?:新訂|改訂|全訂|補訂|増補|最新)版|(?:^|(?<=\s))(?:新訂|改訂|新版)(?=\s|$)")
_FIRST = re.compile(r"初版")
_VOLUME = re.compile(rf"[\s・(\[〔【〈《「/:~〜{_DASHES}]+(上|中|下)(?:巻|冊)?[)\]〕】〉》」]?\s*$|(上|中|下)巻")
_SERIES = re.compile(r"[(\[【〈〔「](?:[^()\[\]【】〈〉〔〕「」]{0,8}(?:単行本|叢書|選書|シリーズ|文庫|新書|ライブラリ|電子版)|(?:cd|dvd)[^()\[\]【】]{0,6})[)\]】〉〕」]")
_SPLIT = re.compile(rf"[:~〜～/|()\[\]〈〉《》「」『』【】〔〕\s{_DASHES}]+")
_ABBREVIATED = {"独禁法": "独占禁止法", "民訴法": "民事訴訟法", "刑訴法": "刑事訴訟法", "労基法": "労働基準法", "消契法": "消費者契約法", "個情法": "個人情報保護法", "金商法": "金融商品取引法", "不競法": "不正競争防止法"}
_LEAD = re.compile(r"^[\s・:]*(?:詳説|詳解|図解|図説|実例|逐条|最新|新版|要説|解説)(?=[\s・:]|[^\s・:]{6})[\s・:]*")
_SAME_WORD = [("便覧", "ハンドブック"), ("手引き", "手引"), ("入門書", "入門")]
_ROLE = re.compile(r"\s*(?:\[?(?:編著|監修|共著|編集|著者?|編|訳|他編|他著|他)\]?|\[?(?:ほか|他)\]?|[\[(](?:ほか|他|著|編)[\])])\s*$")
_ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925, "大正": 1911}
#: share of matching letters below which two titles are different works
ALIKE = 0.72
#: share below which the rules ask no further; a length gap that alone leaves less needs no distance
LEAST = 0.7
#: pages by which records of one year and one end of a title may differ and still meet for certain
PAGES = 13
#: log-odds below which a pair is no candidate: its odds move no rival's marginal
FLOOR = -5.0
#: rounds of messages after which an error tells that they have not settled
ROUNDS = 200
_HAN = re.compile("[㐀-鿿]")
FIELDS = ("title", "publisher", "author", "year", "edition", "volume", "pages")


def clean(text: str | None) -> str:
    return _HIDDEN.sub("", unicodedata.normalize("NFKC", text or "")).translate(_FOLD).lower().strip()


def number_of(text: str) -> int | None:
    """The edition's number; 0 for a revised edition without one; None where nothing is said."""
    m = _EDITION.search(text)
    if m:
        n = m.group(1) or m.group(2)
        return int(n) if n.isdigit() else _NUMBER[n]
    return 1 if _FIRST.search(text) else 0 if _REVISED.search(text) else None


def year_of(text: str) -> int | None:
    m = re.search(r"(?<![0-9])(1[89][0-9]{2}|20[0-9]{2})(?![0-9])", text)
    if m:
        return int(m.group())
    m = re.search(r"(令和|平成|昭和|大正)\s*([0-9]+|元)\s*年?", text)
    return _ERAS[m.group(1)] + (1 if m.group(2) == "元" else int(m.group(2))) if m else None


def people(text: str) -> list[tuple[str, str]]:
    """``(family, whole)`` spellings of the authors; a family name alone has no whole."""
    out = []
    for part in re.split(r"[・,、;/／；]+", _strip_roles(text)):
        part = _strip_roles(part.strip())
        words = part.split()
        if not words:
            continue
        if part.isascii():
            family, given = (words[-1], "".join(words[:-1])) if len(words) > 1 else (words[0], "")
        elif len(words) > 1:
            family, given = words[0], "".join(words[1:])
        elif re.fullmatch(r"[㐀-鿿々ニハロカエタト]{3,}", part):
            family, given = part[:2], part[2:]
        else:
            family, given = part, ""
        f = spell(family)
        out.append((f, f + spell(given) if given else ""))
    return [x for x in out if x[0]]


def _strip_roles(text: str) -> str:
    while (short := _ROLE.sub("", text)) != text:
        text = short
    return text


def read(title: str, publisher: str, author: str, year: str, edition: str, volume: str, pages: int | None) -> dict:
    """The comparable parts of a record."""
    t = _SERIES.sub(" ", clean(title))
    said = [number_of(clean(edition)), number_of(t)]
    numbers = [x for x in said if x is not None]
    t = _REVISED.sub(" ", _EDITION.sub(" ", t)).replace("初版", " ").strip()
    m = _VOLUME.search(t)
    v = clean(volume)[:1] or (m and (m.group(1) or m.group(2))) or ""
    t = _VOLUME.sub(" ", t)
    for short, long in _ABBREVIATED.items():
        if short in t:
            t = t.replace(short, long)
    while (rest := _LEAD.sub("", t)) != t:
        t = rest
    for word, usual in _SAME_WORD:
        t = t.replace(word, usual)
    t = re.sub(r"ガイド(?!ブック|ライン)(?=$|[^ァ-ヺー])", "ガイドブック", t)
    parts = [re.sub(r"[\W_]|の", "", p) for p in _SPLIT.split(t)]
    parts = [p for p in parts if p]
    main, sub = (parts[0], "".join(parts[1:])) if parts else ("", "")
    names = people(clean(author))
    return {
        "main": main, "sub": sub, "families": _JOIN.join(f for f, _ in names), "wholes": _JOIN.join(w for _, w in names), "others": bool(re.search(r"ほか|他", clean(author))),
        "y": year_of(clean(year)), "pages": pages, "edition": max(numbers) if numbers else None, "volume": v, "press": re.sub(r"[\W_]|株式会社|有限会社|合同会社|^発売元|^発行", "", re.sub(r"\((?:株|有|同)\)|[㈱㈲]", "", clean(publisher))),
    }


def deletions(text: str) -> set[str]:
    """The text and what one missing letter leaves of it: texts one letter or one swap apart share a member."""
    return {text, *(text[:i] + text[i + 1 :] for i in range(len(text)))} if len(text) > 3 else {text}


def block_keys(r: dict) -> list[str]:
    """Combinations of parts that records of one book share even if several parts are off.

    Main titles, and whole titles, one letter or one swap apart always meet, whatever
    the other parts are. With more errors in them, records meet by one end of
    the main title and any of: the subtitle, a family name, year and pages (a year and
    ``PAGES`` apart at most); or by both ends and one end of the subtitle.
    """
    main, sub = r["main"], r["sub"]
    if not main:
        return []
    ends = main[:4], main[-4:]
    # main titles that are short or one letter off, and titles the other may write without a separator
    keys = {f"m:{x}" for x in deletions(main)} | {f"m:{x}" for x in deletions(main + sub)}
    keys |= {f"e:{ends[0]}:{ends[1]}:<{sub[:2]}", f"e:{ends[0]}:{ends[1]}:>{sub[-2:]}"}
    if sub:
        keys |= {f"a:{ends[0]}:{sub}", f"z:{ends[1]}:{sub}"}
    for f in set(r["families"].split(_JOIN)) - {""}:
        keys |= {f"f:{ends[0]}:{f}", f"g:{ends[1]}:{f}"}
        if sub:
            keys.add(f"s:{sub}:{f}")
    if r["y"] and r["pages"]:
        band = r["pages"] // PAGES
        keys |= {f"{k}:{x}:{y}:{p}" for k, x in zip("yx", ends) for y in (r["y"], r["y"] + 1) for p in (band, band + 1)}
    return sorted(keys)


_JOIN = "\x1f"


def easy_odds(a: str, b: str) -> Column:
    """What year, pages, edition and volume of two structs of parts add to the log-odds: exact, in the JVM."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    gap = F.abs(x("y") - y("y"))
    year = F.when(gap.isNull(), 0.0).when(gap == 0, 2.0).when(gap == 1, 1.0).when(gap == 2, -3.5).otherwise(-6.5)
    leaves = F.abs(x("pages") - y("pages"))
    pages = F.when(leaves.isNull() | (x("pages") == 0) | (y("pages") == 0), 0.0).when(leaves <= 4, 2.5).when(leaves <= 12, 1.5).when(leaves <= 25, -1.5).otherwise(-3.5)
    ea, eb = x("edition"), y("edition")
    other = F.when(ea == 0, eb).otherwise(ea)
    first = lambda e: F.when(F.coalesce(e, F.lit(0)) == 0, 1).otherwise(e)
    edition = (
        F.when(ea.eqNullSafe(eb), F.when(ea > 1, 1.0).otherwise(0.3))
        # a revision without a number is no first edition
        .when(F.coalesce(ea == 0, F.lit(False)) | F.coalesce(eb == 0, F.lit(False)), F.when(F.coalesce(other, F.lit(1)) == 1, -0.5).otherwise(0.5))
        .when(first(ea) != first(eb), F.when(ea.isNotNull() & eb.isNotNull(), -6.0).otherwise(-2.0)).otherwise(0.0)
    )
    va, vb = x("volume"), y("volume")
    volume = F.when(va != vb, F.when((va != "") & (vb != ""), -8.0).otherwise(-3.0)).when(va != "", 1.0).otherwise(0.0)
    return year + pages + edition + volume


#: the most that titles, authors and publishers can add, and what every pair begins with
PRIOR, TITLES, AUTHORS, PRESS = -2.0, 5.0, 3.5, 1.0


def text_odds(pairs: pd.DataFrame) -> np.ndarray:
    """Prior and evidence of titles, authors and publishers of each pair; -20 where the titles are of different works.

    Columns end in ``_a`` and ``_b``: main, sub, families and wholes (joined lists), press. All pairs at once.
    """
    main_a, main_b, sub_a, sub_b = (pairs[c].tolist() for c in ("main_a", "main_b", "sub_a", "sub_b"))
    whole_a, whole_b = [x + y for x, y in zip(main_a, sub_a)], [x + y for x, y in zip(main_b, sub_b)]
    m, w = alike(main_a, main_b), alike(whole_a, whole_b)
    best = np.maximum(m, w)
    out = PRIOR + np.where(best == 1, 3.0, np.where(best >= 0.85, 2.0, 0.0))
    both = np.array([bool(x and y) for x, y in zip(sub_a, sub_b)], dtype=bool)
    s = np.maximum(alike(sub_a, sub_b), w)
    out += np.where(both, np.where(s >= 0.85, 2.0, np.where(s >= LEAST, 0.5, -6.0)), 0.0)
    out += author_odds(*(pairs[c].tolist() for c in ("families_a", "families_b", "wholes_a", "wholes_b")))
    press_a, press_b = pairs["press_a"].tolist(), pairs["press_b"].tolist()
    known = np.array([bool(x and y) for x, y in zip(press_a, press_b)], dtype=bool)
    script = [np.array([(x.isascii(), bool(_HAN.search(x))) for x in side], dtype=bool).reshape(-1, 2) for side in (press_a, press_b)]
    p = D.jaro_winkler(press_a, press_b)
    out += np.where(known, np.where(p >= 0.85, 1.0, np.where((p < 0.6) & (script[0] == script[1]).all(axis=1), -1.0, 0.0)), 0.0)
    return np.where(best < ALIKE, -20.0, out)


def alike(a: list[str], b: list[str]) -> np.ndarray:
    """Likenesses; 0 where one is empty or the lengths alone leave less than ``LEAST``."""
    n, m = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a, b))
    out = np.fromiter((x == y for x, y in zip(a, b)), dtype=np.float64, count=len(a))
    ask = np.flatnonzero((out == 0) & (n > 0) & (m > 0) & (np.minimum(n, m) >= LEAST * np.maximum(n, m)))
    if len(ask):
        out[ask] = D.likeness([a[k] for k in ask], [b[k] for k in ask])
    return out


def author_odds(families_a: list[str], families_b: list[str], wholes_a: list[str], wholes_b: list[str]) -> np.ndarray:
    """A whole name in common, a near one or a family name alone, a family name, or none in common; 0 where one side names nobody."""
    out = np.zeros(len(families_a))
    at, x, y = [], [], []
    for k, (fa, fb, wa, wb) in enumerate(zip(families_a, families_b, wholes_a, wholes_b)):
        if not fa or not fb:
            continue
        fa, fb, wa, wb = fa.split(_JOIN), fb.split(_JOIN), wa.split(_JOIN), wb.split(_JOIN)
        if {w for w in wa if w} & set(wb):
            out[k] = AUTHORS
            continue
        given = dict(zip(reversed(fb), reversed(wb)))
        shared = [(w, given[f]) for f, w in zip(fa, wa) if f in given]
        out[k] = 2.5 if any("" in pair for pair in shared) else 1.0 if shared else -4.0
        if out[k] < 2.5:
            for v in wa:
                for w in wb:
                    if v and w:
                        at.append(k)
                        x.append(v)
                        y.append(w)
    if at:
        near = np.unique(np.array(at)[D.jaro_winkler(x, y) > 0.94])
        out[near] = 2.5
    return out


_PARTS = "main string, sub string, families string, wholes string, others boolean, y int, pages int, edition int, volume string, press string"


def parsed(records: DataFrame, side: str) -> DataFrame:
    """Records as ``(side, id, parts, keys)``; of rows of one id the latest counts, records of equal parts share a row ``rep``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                x = read(*[None if isinstance(v, float) and math.isnan(v) else v for v in (r.title, r.publisher, r.author, r.year, r.edition, r.volume)], None if pd.isna(r.pages) else int(r.pages))
                rows.append((r.id, *x.values(), block_keys(x)))
            out = pd.DataFrame(rows, columns=["id", *[c.split()[0] for c in _PARTS.split(", ")], "keys"])
            yield out.assign(y=out["y"].astype("Int64"), pages=out["pages"].astype("Int64"), edition=out["edition"].astype("Int64"))

    latest = records.where("id is not null").groupBy("id").agg(F.max(F.struct("at", *FIELDS)).alias("m")).select("id", *[F.col(f"m.{c}").alias(c) for c in FIELDS])
    return latest.mapInPandas(run, f"id string, {_PARTS}, keys array<string>").withColumn("side", F.lit(side))


def match_records(left: DataFrame, right: DataFrame, *, rounds: int = ROUNDS, settle: float = 0.01, twin: float = 4.0, doubt: float = 0.5, crowd: int = 300) -> DataFrame:
    """``(left_id, right_id, probability)`` of every candidate pair.

    Inputs have ``id, title, publisher, author, year, edition, volume, pages, at``;
    ids are strings; of repeated ids the latest row counts. Empty parts are no
    evidence. A book that stands twice in one source (``twin`` log-odds or more
    between its records, ``doubt`` where both also fit one record of the other
    source by 2, or all parts equal) is one class, and each of its records
    gets the class's pairs. Blocks of more than ``crowd`` records are cut into chunks
    whose pairs are blocks of their own, so a block is bounded and no pair is lost.
    Empty inputs give no pairs.
    """
    everyone = materialize(parsed(left, "l").unionByName(parsed(right, "r")), "records")
    names = [c.split()[0] for c in _PARTS.split(", ")]
    # records of equal parts meet once; copies come back by their class
    same = F.xxhash64("side", *names)
    reps = everyone.withColumn("rep", same)
    heads = materialize(reps.groupBy("side", "rep").agg(F.first(F.struct(*names)).alias("p"), F.first("keys").alias("keys")).select("side", "rep", "p.*", "keys"), "heads")
    keyed = heads.select("side", "rep", F.explode(F.array_distinct(F.transform("keys", lambda k: F.xxhash64(k)))).alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / crowd).cast("int").alias("chunks"))
    # a crowded key is cut into chunks, and there is a block for every two chunks: every pair meets in one of them
    own = keyed.join(shared, "key").withColumn("own", F.pmod("rep", "chunks").cast("int"))
    met_by = F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least("own", j).alias("low"), F.greatest("own", j).alias("high"))))
    blocks = materialize(own.select("side", "rep", "key", "own", met_by.alias("of")).select("side", "rep", "key", "own", "of.low", "of.high"), "blocks")
    a, b = [blocks.select(F.col("side").alias(f"s{x}"), F.col("rep").alias(x), F.col("own").alias(f"own_{x}"), "key", "low", "high") for x in "ab"]
    pairs = a.join(b, ["key", "low", "high"]).where("a <> b and ((sa = sb and a < b) or (sa = 'l' and sb = 'r')) and (low = high or own_a <> own_b)").select("sa", "a", "sb", "b").distinct()
    struct = F.struct(*names)

    def with_parts(ends: DataFrame) -> DataFrame:
        return ends.join(heads.select(F.col("side").alias("sa"), F.col("rep").alias("a"), struct.alias("pa")), ["sa", "a"]).join(heads.select(F.col("side").alias("sb"), F.col("rep").alias("b"), struct.alias("pb")), ["sb", "b"])


    @F.pandas_udf("double")
    def texts(pairs: pd.DataFrame) -> pd.Series:
        return pd.Series(text_odds(pairs))

    names_of = [c for c in ("main", "sub", "families", "wholes", "press")]
    texts_of = texts(F.struct(*[F.col(f"p{x}.{c}").alias(f"{c}_{x}") for c in names_of for x in "ab"]))

    # titles less alike than log_odds asks for are out in the JVM; a swap is two edits here and one there
    def apart(x: Column, y: Column) -> Column:
        return F.levenshtein(x, y) > 2 * (1 - ALIKE) * F.greatest(F.length(x), F.length(y))

    far = apart(F.col("pa.main"), F.col("pb.main")) & apart(F.concat("pa.main", "pa.sub"), F.concat("pb.main", "pb.sub"))
    # pairs that no title, author or publisher can bring to the odds asked for need no comparison of texts
    floor = F.when(F.col("sa") == F.col("sb"), twin).otherwise(FLOOR)
    able = with_parts(pairs).withColumn("easy", easy_odds("pa", "pb")).where(F.col("easy") + (PRIOR + TITLES + AUTHORS + PRESS) >= floor)
    scored = materialize(able.where(~far).select("sa", "a", "sb", "b", (texts_of + F.col("easy")).alias("w")).where(F.col("w") > FLOOR), "scored")
    # records of one source with little to compare are one book too if both fit one record of the other
    # source and nothing between them speaks against it; such pairs need not share a block
    strong = scored.where(F.col("w") >= 2.0).where("sa = 'l' and sb = 'r'")
    ends = strong.select(F.col("sa").alias("side"), F.col("a").alias("x"), F.col("b").alias("mate")).union(strong.select("sb", "b", "a"))
    met = ends.join(ends.select(F.col("x").alias("y"), "mate"), "mate").where("x < y").select(F.col("side").alias("sa"), F.col("x").alias("a"), F.col("side").alias("sb"), F.col("y").alias("b")).distinct()
    shared = with_parts(met).where(texts_of + easy_odds("pa", "pb") >= doubt).select("a", "b")
    twins = scored.where((F.col("sa") == F.col("sb")) & (F.col("w") >= twin)).select("a", "b").union(shared)
    classes = connected_components(twins.union(heads.select(F.col("rep").alias("a"), F.col("rep").alias("b"))))
    of = lambda c, n: classes.select(F.col("node").alias(c), F.col("component").alias(n))
    cross = scored.where("sa = 'l' and sb = 'r'").join(of("a", "i"), "a").join(of("b", "j"), "b").groupBy("i", "j").agg(F.max("w").alias("w"))
    held = belief_propagation(cross, rounds, settle)
    members = reps.select("side", "id", "rep").join(of("rep", "c"), "rep")
    out = held.join(members.where("side = 'l'").select(F.col("c").alias("i"), F.col("id").alias("left_id")), "i").join(members.where("side = 'r'").select(F.col("c").alias("j"), F.col("id").alias("right_id")), "j")
    return out.select("left_id", "right_id", "probability")


def belief_propagation(pairs: DataFrame, rounds: int, settle: float) -> DataFrame:
    """``(i, j, probability)`` under at most one partner for each ``i`` and each ``j``.

    ``pairs(i, j, w)``: local log-odds. Each round sends the messages of the left
    factors and then of the right ones; it ends when no message moves by more than
    ``settle``, and if that takes more than ``rounds`` it is an error. A node's rivals are summed by aggregation, so a node with many
    pairs is no task of its own.
    """
    top = 30.0
    state = materialize(pairs.select("i", "j", "w", F.lit(0.0).alias("from_left"), F.lit(0.0).alias("from_right")), "messages")
    for _ in range(rounds):
        for node, sent, got in (("i", "from_left", "from_right"), ("j", "from_right", "from_left")):
            odds = F.exp(F.least(F.col("w") + F.col(got), F.lit(top)))
            total = state.groupBy(node).agg(F.sum(odds).alias("total"))
            rivals = F.greatest(F.col("total") - odds, F.lit(0.0))
            state = state.join(total, node).withColumn("new", -F.log1p(rivals)).select("i", "j", "w", F.col("new").alias(sent), F.col(got), *([F.abs(F.col("new") - F.col(sent)).alias("moved_l")] if node == "i" else ["moved_l", F.abs(F.col("new") - F.col(sent)).alias("moved_r")]))
        state = materialize(state, "messages")
        moved = state.agg(F.max(F.greatest("moved_l", "moved_r"))).first()[0]
        state = state.drop("moved_l", "moved_r")
        if moved is None or moved <= settle:
            belief = F.col("w") + F.col("from_left") + F.col("from_right")
            return state.select("i", "j", (F.lit(1.0) / (1 + F.exp(-belief))).alias("probability"))
    raise RuntimeError(f"messages still move by {moved} after {rounds} rounds")
