"""Template residue, filler and error pages in place of real text.

Texts are cut into units (lines, and sentences within them). Distinct units,
digits aside, are mined for message templates with a prefix tree of fixed depth:
units of as many tokens that begin alike share a leaf, where the commonest
founds a template that all units in enough agreement join. A template is classified once and
its verdict goes to all its units; unresolved slots are looked for in each unit by
itself, since a template hides what its places hold. A document is residue if
what is left of real text beside residue is at most one sentence.

What a template is follows from where it stands. One without open places that
documents of several kinds share word for word belongs to no subject: it is a
message if nearly all these documents hold nothing else of their own, navigation
if a part of them do, and ordinary text if they hold their own text beside it. No
word of it is looked at. Only templates too rare for that, and those with open places
(logs, forms), go by their form and by lists of usual words.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.runtime import checked_broadcast, materialize

DEPTH, AGREE, LEAF, _JOIN = 3, 0.6, 20_000, "\x1f"
_TOKEN = re.compile(r"[぀-ゟ]+|[゠-ヿー]+|[㐀-鿿々]+|[A-Za-z]+|\d+|\s+|.", re.S)
_HIDDEN = re.compile(r"[­​-‏⁠-⁤﻿\x00-\x08\x0e-\x1f]")

# Unfilled parts: each notation of a slot, or what programs print for a missing value.
SLOT = re.compile(
    r"\{\{.*?\}\}|\{%.*?%\}|<%.*?%>|<\?(?:php|=).*?\?>|\$\{[^{}]+\}|<!-- ?(?:BEGIN|END) [^>]*-->|\[\[[^\[\]]+\]\]|\[(?:item|row|node|insert)[: ][^\]]+\]"
    r"|([●○◯〇@])\1[^\s●○◯〇@]{1,14}\1\1|__[^\W_](?:[^_\s]|_(?!_))*__|(?<![\d%])%[^\W\d]\w{0,14}%|(?<![0-9A-Za-z#])#[^\W\d]\w{0,14}#|《\w{1,14}》|<\w{1,14}>(?!.*</)|(?<![{$])\{\w{1,14}\}"
    r"|[〔【(\[]\w{1,14}(?:未記入|未定|未入力|を?入力|を?記入|を?記載|をここに記載)[〕】)\]]|\[object Object\]|#(?:N/A|REF!|VALUE!|NAME\?|DIV/0!)|\(null\)|(?<![A-Za-z])(?:NaN|undefined|null|nil|None)(?![A-Za-z])",
    re.I,
)
_MARKED = re.compile(r"[{<%$\[#_@●○◯〇《【〔(]|n(?:an|one|ull|il)|undefined", re.I)
LOG = re.compile(
    r"^(?:\{\"(?:status|error|code|message)\"|Traceback \(most recent|File \"|at [\w.$<>]+ ?\(|raise \w+|\w+(?:\.\w+)*(?:Error|Exception)\b|(?:Warning|Fatal error|Notice|Error|ERROR|FATAL): |<\??(?:Error|html|xml)\b|HTTP[ /]?\d|Error \d|エラー ?\d)"
)
NOTICE_EN = re.compile(
    r"please (?:enable|try|wait)|session has expired|sign in again|enable (?:javascript|scripts|cookies)|requires? a browser|could not be (?:located|found)|access (?:from|denied|to this)|blocked by|checking your browser|^loading\b|try again|quote the reference|^return to|cannot start"
    r"|^noscript|under maintenance|not found$|unauthorized|forbidden|bad gateway|gateway time-?out|service unavailable|too many requests|internal server error|verify (?:that )?you are|are you a robot|subscribe to (?:read|continue)",
    re.I,
)
_SCREEN = r"ページ|画面|サーバ|ログイン|認証|アクセス|要求|応答|資料|目次|利用|閲覧|スクリプト|javascript|cookie|ブラウザ|再度|再読込|url|照会番号|メンテナンス|会員|エラー|読み込み|移動|削除|チェック|権限|上限|期限|有効|登録|接続"
NOTICE_JA = re.compile(rf"(?=.*(?:{_SCREEN})).{{0,70}}(?:ください|下さい|ません|ました|ます|です|でした)[。.!]?(?:\(\d*\))?$|^(?:読み込み中|しばらくお待ち)|^.{{0,16}}(?:が必要です|が多すぎます|タイムアウト)", re.I)
_SCREEN_END = re.compile(r"(?:ください|下さい|ません|ました|ます|です|でした|必要です|多すぎます|タイムアウト)|^(?:読み込み中|しばらく)")
FILLER = re.compile(r"^(?:.{0,12}(?:ここに.{0,8}(?:入り|入れ|表示|置)|下に.{0,8}置いて).{0,10}|ダミー.{0,12}|(?:サンプル.{0,4}){1,}|(?:テスト){2,}|.{0,16}仮の?(?:文|内容|文章)(?:です|を載せています)|原稿差替え?予定|本文未作成|(.)\1{4,})[。.]?$|\blorem ipsum\b", re.I)
MENU = {"ホーム", "検索", "書棚", "ヘルプ", "トップ", "蔵書検索", "目次", "ログイン", "新規登録", "メニュー", "閉じる", "本文へ移動", "サイトマップ", "お問い合わせ", "戻る", "home", "books", "contents", "search", "help", "menu", "login", "top"}
#: function words that English text cannot do without; mock Latin has none of them
ENGLISH = set("the of is to in and a for on at it that was are be by with from as this not or an we who if no two".split())
QUOTED = re.compile(r"[「『“\"].*[」』”\"]")
EXCERPT = re.compile(r"^```|抜粋|次の(?:表示|出力|記録)|(?:表示|出力|記録)は次のとおり|^\$ |log excerpt", re.I)
#: verdicts of a unit
KINDS = ("real", "head", "menu", "notice", "log", "filler", "excerpt")
#: kinds of documents that a template must occur in to be of no subject
FOREIGN = 3
#: own units a document may hold beside messages; share of a template's documents that hold no more, for messages and for navigation
BESIDE, MESSAGE, NAVIGATION = 1, 0.6, 0.1


def plain(text: str) -> str:
    """Compatibility form without invisible characters."""
    return _HIDDEN.sub("", unicodedata.normalize("NFKC", text)).strip()


def verdict(template: str, words: bool = True) -> str:
    """The kind of a template by its form and, unless ``words`` is false, by usual words: real, head, menu, notice, log, filler or excerpt."""
    t = template.strip()
    if EXCERPT.search(t):
        return "excerpt"
    if LOG.search(t):
        return "log"
    parts = [p for p in re.split(r"\s*[|>/・]\s*|\s+", t.lower()) if p]
    if words and parts and all(p in MENU for p in parts) or re.fullmatch(r"ref [0-9a-f<*>]+", t):
        return "menu"
    if words and not QUOTED.search(t):
        if NOTICE_EN.search(t) and len(t.split()) <= 22 or _SCREEN_END.search(t) and NOTICE_JA.search(t):
            return "notice"
        if FILLER.search(t):
            return "filler"
    return "real" if re.search(r"[。.!?]$|^[-*・] |[…·]\s*\d|\.{3}", t) or len(t) > 60 else "head"


def mock_latin(text: str) -> bool:
    """Latin letters in words, none of which holds English together."""
    words = re.findall(r"[a-z]+", text.lower())
    return len(words) >= 6 and bool(re.fullmatch(r"[A-Za-z][A-Za-z ,;]+[.]?", text)) and not ENGLISH & set(words)


def mine(skeletons: list[str], counts: list[int]) -> list[str]:
    """The template of each skeleton of one leaf; skeletons and templates are tokens joined by the unit separator.

    The commonest skeleton left founds a template, all that agree with it in enough tokens join,
    and the places where they differ become open.
    """
    tokens = [s.split(_JOIN) for s in skeletons]
    ids: dict[str, int] = {}
    rows = np.array([[ids.setdefault(t, len(ids)) for t in ts] for ts in tokens], dtype=np.int32)
    left = np.array(sorted(range(len(rows)), key=lambda i: (-counts[i], skeletons[i])))
    out = [""] * len(rows)
    while len(left):
        same = rows[left] == rows[left[0]]
        joins = same.mean(axis=1) >= AGREE
        fixed = same[joins].all(axis=0)
        members, left = left[joins], left[~joins]
        if fixed.mean() < AGREE:  # a template of places alone says nothing: its units stand for themselves
            for m in members:
                out[m] = _JOIN.join(tokens[m])
        else:
            text = _JOIN.join(t if f else "<*>" for t, f in zip(tokens[members[0]], fixed))
            for m in members:
                out[m] = text
    return out


def units_of(text: Column) -> Column:
    """Lines, and the sentences in them; a full stop inside quotation marks ends none."""
    return F.filter(F.split(text, r"[\r\n\x{85}\x{2028}\x{2029}]+|(?<=。)(?![」』”\")）])|(?<=[a-z]{2}\.) +(?=[A-Z])"), lambda x: x.rlike(r"[^\s\p{Z}]"))


def classify_units(units: DataFrame) -> DataFrame:
    """One row a distinct unit: ``h, t, kind, shared, slots, strong, sentence``; ``units``: ``h`` (one for units that differ in digits alone), ``unit`` and ``seen`` (a bit a kind of document), repeats allowed.

    ``t`` names its template, ``kind`` is the template's by form and words, or by form alone where it is ``shared``:
    without open places, in ``FOREIGN`` kinds of documents.
    """

    def skeletons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h, unit, k, seen in pdf.itertuples(index=False):
                t = plain(unit)
                found = [m.group() for m in SLOT.finditer(t)] if _MARKED.search(t) else []
                tokens = _TOKEN.findall(re.sub(r"\d+", "0", re.sub(r"\b[0-9a-f]{8,}\b", "<*>", t)))
                leaf = _JOIN.join([str(len(tokens)), *tokens[:DEPTH]])
                rows.append((h, _JOIN.join(tokens), leaf, k, mock_latin(t), len(found), bool(re.search(r"[。.]$", t)), sum(not re.fullmatch(r"null|nil|none|nan|undefined", x, re.I) for x in found), seen))
            yield pd.DataFrame(rows, columns=["h", "skeleton", "leaf", "k", "mock", "slots", "sentence", "strong", "seen"])

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by leaf; a leaf may go on in the next batch
        place, held = None, ([], [], [])
        for pdf in batches:
            done: tuple[list, list] = ([], [])
            for s, skeleton, k, leaf, part in zip(*(pdf[c].tolist() for c in ("s", "skeleton", "k", "leaf", "part"))):
                if (leaf, part) != place:
                    if held[0]:
                        done[0].extend(held[0])
                        done[1].extend(mine(held[1], held[2]))
                    place, held = (leaf, part), ([], [], [])
                held[0].append(s)
                held[1].append(skeleton)
                held[2].append(k)
            if done[0]:
                yield pd.DataFrame({"s": done[0], "template": done[1]})
        if held[0]:
            yield pd.DataFrame({"s": held[0], "template": mine(held[1], held[2])})

    @F.pandas_udf(T.StringType())
    def judged(templates: pd.Series, shared: pd.Series) -> pd.Series:
        return pd.Series([verdict(t, words=not x) for t, x in zip(templates, shared)], dtype=object)

    distinct = units.groupBy("h").agg(F.min("unit").alias("unit"), F.count(F.lit(1)).alias("k"), F.bit_or("seen").alias("seen"))
    seen = materialize(distinct.mapInPandas(skeletons, "h long, skeleton string, leaf string, k long, mock boolean, slots int, sentence boolean, strong int, seen long").withColumn("s", F.xxhash64("skeleton")), "units")
    # texts are grouping keys here and no aggregate holds one, so the grouping hashes and does not sort
    kinds = materialize(seen.groupBy("s", "skeleton", "leaf").agg(F.sum("k").alias("k"), F.bit_or("seen").alias("seen"), F.max(F.col("slots") > 0).alias("slotted")), "skeletons")
    # a leaf beyond LEAF skeletons is mined in parts, and then the parts' templates as one leaf
    crowd = kinds.groupBy("leaf").count().where(F.col("count") > LEAF).select("leaf", F.ceil(F.col("count") / LEAF).alias("parts"))
    spread = kinds.join(crowd, "leaf", "left").withColumn("part", F.pmod("s", F.coalesce("parts", F.lit(1))))
    in_leaves = lambda df: df.repartition("leaf", "part").sortWithinPartitions("leaf", "part").select("s", "skeleton", "leaf", "part", "k").mapInPandas(leaves, "s long, template string")
    mined = materialize(in_leaves(spread), "templates")
    if not crowd.isEmpty():
        first = spread.where("parts is not null").join(mined, "s").groupBy("leaf", F.col("template").alias("skeleton")).agg(F.sum("k").alias("k")).withColumn("s", F.xxhash64("leaf", "skeleton")).withColumn("part", F.lit(0))
        merged = first.join(in_leaves(first).withColumnRenamed("template", "whole"), "s").select("leaf", F.col("skeleton").alias("template"), "whole")
        again = mined.join(kinds.select("s", "leaf"), "s").join(merged, ["leaf", "template"], "left")
        mined = materialize(again.select("s", F.coalesce("whole", "template").alias("template")), "templates")
    mined = mined.withColumn("t", F.xxhash64("template"))
    spans = mined.join(kinds.select("s", "seen", "slotted"), "s").groupBy("t", "template").agg((F.bit_count(F.bit_or("seen")) >= FOREIGN).alias("wide"), F.max("slotted").alias("slotted"))
    text = F.replace("template", F.lit(_JOIN), F.lit(""))
    shared = F.col("wide") & ~F.col("slotted") & ~text.rlike(r"<\*>|\p{N}")
    spans = spans.select("t", text.alias("template"), shared.alias("shared")).withColumn("kind", judged("template", "shared")).select("t", "shared", "kind")
    of_skeleton = mined.select("s", "t").join(spans, "t")
    return seen.select("h", "s", "mock", "slots", "strong", "sentence").join(of_skeleton, "s").select("h", "t", "shared", F.when(F.col("mock"), "filler").otherwise(F.col("kind")).alias("kind"), "slots", "strong", "sentence")


def residue_documents(df: DataFrame, *, key: str, text: str, group: str | None = None) -> DataFrame:
    """``(key, residue, real, slots)``: documents whose text is residue.

    ``group``: a column that tells kinds of documents apart; without it no template is shared, and all go by their form and words.
    Null, empty and blank texts are no case; neither are texts that quote a message
    or a slot in a sentence of their own or as an excerpt. Rows of one key count
    as one document. An empty table gives no rows; other columns are ignored.
    """
    kind_bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.coalesce(F.col(group).cast("string"), F.lit(""))), F.lit(63)).cast("int")) if group else F.lit(1).cast("long")
    docs = df.select(F.col(key).alias("key"), kind_bit.alias("seen"), F.explode(units_of(F.col(text))).alias("unit")).where("key is not null")
    units = materialize(docs.select("key", F.xxhash64(F.regexp_replace("unit", "[0-9]+", "0")).alias("h"), "unit", "seen"), "lines")
    kinds = classify_units(units.select("h", "unit", "seen"))
    # verdicts by number keep what is shuffled narrow
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("byte")
    kinds = materialize(kinds.select("h", "t", "shared", number.alias("kind"), F.col("slots").alias("slots"), (F.col("strong") > 0).alias("strong"), "sentence"), "verdicts")
    each = units.select("key", "h").join(kinds, "h")
    of = lambda *names: F.col("kind").isin([KINDS.index(n) + 1 for n in names])
    # weak marks (null, None ...) are slots only where no sentence of words surrounds them
    open_slots = F.when(F.col("strong") | ~F.col("sentence") | (F.col("slots") > 1), F.col("slots")).otherwise(0)
    one = lambda c: F.sum(c.cast("int"))
    is_slot = (open_slots > 0) & of("real", "head", "filler", "notice", "menu")
    by = each.groupBy("key").agg(
        one(is_slot).alias("slot_units"), F.sum(F.when(is_slot, open_slots).otherwise(0)).alias("slots"),
        one(is_slot & F.col("sentence") & ((open_slots == 1) | ~F.col("strong"))).alias("told"), one(of("notice")).alias("notice"), one(of("log")).alias("log"),
        one(of("filler")).alias("filler"), one(of("excerpt")).alias("excerpt"), one(of("real") & ~is_slot).alias("real"),
        one(~F.col("shared") & ~is_slot & of("real", "head")).alias("own"),
    )
    by = materialize(by, "documents")
    # shared templates by the company they keep: the share of their documents that hold hardly anything of their own
    common = checked_broadcast(kinds.where(F.col("shared") & of("real", "head")).select("h", "t", of("real").alias("is_real")))
    shared = units.select("key", "h").join(common, "h").groupBy("key", "t").agg(F.count(F.lit(1)).alias("n"), one(F.col("is_real")).alias("n_real"))
    shared = materialize(shared, "shared")
    alone = shared.join(by.select("key", (F.col("own") <= BESIDE).cast("int").alias("bare")), "key").groupBy("t").agg(F.avg("bare").alias("alone"))
    apart = checked_broadcast(materialize(alone.where(F.col("alone") >= NAVIGATION).select("t", (F.col("alone") >= MESSAGE).alias("message")), "verdicts"))
    moved = shared.join(apart, "t").groupBy("key").agg(F.sum(F.when(F.col("message"), F.col("n")).otherwise(0)).alias("messages"), F.sum("n_real").alias("not_real"))
    by = by.join(moved, "key", "left").na.fill(0, ["messages", "not_real"])
    # a slot in the only such sentence is told about, not left open
    mention = (F.col("slot_units") == 1) & (F.col("told") == 1)
    slots = F.when(mention, 0).otherwise(F.col("slot_units"))
    log = F.when(F.col("excerpt") > 0, 0).otherwise(F.col("log"))
    residue = F.col("notice") + log + F.col("filler") + F.col("messages") + slots
    real = F.col("real") - F.col("not_real") + F.when(mention, 1).otherwise(0)
    return by.select("key", residue.alias("residue"), real.alias("real"), "slots").where("residue > 0 and (real <= 1 or residue >= 3 * real)")
