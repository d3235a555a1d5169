"""Spellings of one client: phonetic codes, Jaro-Winkler, reading and nickname tables, components.

A typed name is taken apart (company form, line of business, courtesies, order
of the parts) and spelt in Latin letters by its readings. Names are blocked by
the consonants of their sorted parts, whole and less any one of them; spellings
of one block are compared by Jaro-Winkler, accepted pairs and the alias table's
own statements are edges, and connected components are the clients. Names of
companies are near by their own part. Given names of one family differ by a letter,
so persons are near part by part, and never if both are written in characters, which
tell them apart. Stray characters are read as the known character that they replace
in most names. A company's bare name counts only where it stands for one firm, since
firms of one group share it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm import distances as D
from folioforge.llm.codepoints import one_form, with_form
from folioforge.llm.kana import loose_latin, romaji, to_hiragana
from folioforge.operators.graph import connected_components
from folioforge.runtime import materialize

# Usual readings of characters in family and given names.
READINGS = dict(
    pair.split("=")
    for pair in (
        "凪=なぎ 帆=ほ 星=ほし 梓=あずさ 椿=つばき 楓=かえで 楡=にれ 槙=まき 樫=かし 檜=ひのき 渚=なぎさ 湊=みなと 潮=しお 灯=あかり 琴=こと 砂=すな 碧=みどり 笙=しょう 紺=こん 舟=ふな 苔=こけ 茜=あかね 葵=あおい 蓮=はす 蔵=くら 藍=あい 虹=にじ 鈴=すず "
        "銀=しろがね 錨=いかり 雁=かり 雫=しずく 雲=くも 霜=しも 霧=きり 霰=あられ 鮎=あゆ 鶴=つる 鷺=さぎ 鼓=つづみ 畑=はた 槻=つき 嶺=みね 谷=や 路=じ 尾=お 井=い 沢=さわ 瀬=せ 溝=みぞ 館=たて 堀=ほり 縄=なわ 淵=ふち 窪=くぼ 蔭=かげ 垣=がき 辺=べ "
        "島=しま 坂=さか 橋=はし 原=はら 浜=はま 森=もり 越=こし 塚=づか 滝=たき 山=やま 川=かわ 田=た 中=なか 村=むら 木=き 林=はやし 石=いし 小=こ 大=おお 松=まつ 藤=ふじ 高=たか 上=うえ 野=の 香=か 樹=き 則=のり 斗=と 郎=ろう 世=せ 真=ま 乃=の 子=こ 彦=ひこ "
        "悠=ゆう 央=お 平=へい 美=み 也=や 介=すけ 江=え 代=よ 環=たまき 怜=れい 克=かつ 志=し 冴=さえ 尚=なお 晴=はる 陽=よう 律=りつ 透=とう 暁=あき 澄=すみ 栞=しおり 慧=けい 千=ち 義=よし 以=い 響=ひびき 那=な 由=ゆ 寧=ねい 諒=りょう 汰=た 朔=さく"
    ).split()
)
# Names in wide use that are read as a whole.
WHOLE_NAMES = dict(
    pair.split("=")
    for pair in (
        "佐藤=さとう 鈴木=すずき 高橋=たかはし 田中=たなか 伊藤=いとう 渡辺=わたなべ 山本=やまもと 中村=なかむら 小林=こばやし 加藤=かとう 吉田=よしだ 山田=やまだ 佐々木=ささき 山口=やまぐち 松本=まつもと 井上=いのうえ 木村=きむら 斎藤=さいとう 斉藤=さいとう 清水=しみず "
        "山崎=やまざき 阿部=あべ 池田=いけだ 橋本=はしもと 石川=いしかわ 山下=やました 小川=おがわ 長谷川=はせがわ 後藤=ごとう 岡田=おかだ 近藤=こんどう 前田=まえだ 藤田=ふじた 遠藤=えんどう 青木=あおき 坂本=さかもと 村上=むらかみ 太田=おおた 金子=かねこ 福田=ふくだ "
        "西村=にしむら 三浦=みうら 竹内=たけうち 中川=なかがわ 岡本=おかもと 松田=まつだ 原田=はらだ 中野=なかの 小野=おの 田村=たむら 藤原=ふじわら 中山=なかやま 石田=いしだ 小島=こじま 和田=わだ 内田=うちだ 柴田=しばた 酒井=さかい 宮崎=みやざき 横山=よこやま "
        "安藤=あんどう 宮本=みやもと 大野=おおの 今井=いまい 工藤=くどう 千葉=ちば 藤本=ふじもと 増田=ますだ 平野=ひらの 高木=たかぎ 健一=けんいち 健太=けんた 太郎=たろう 一郎=いちろう 花子=はなこ 裕子=ゆうこ 洋子=ようこ 恵子=けいこ 幸子=さちこ 和子=かずこ "
        "直樹=なおき 大輔=だいすけ 翔太=しょうた 美咲=みさき 由美=ゆみ 明美=あけみ 京子=きょうこ 浩二=こうじ 正樹=まさき 達也=たつや 和也=かずや 智子=ともこ 久美子=くみこ 健二=けんじ 浩一=こういち 誠一=せいいち"
    ).split()
)
# Short forms of given names in Latin letters.
NICKNAMES = dict(
    pair.split("=")
    for pair in (
        "bill=william will=william billy=william bob=robert rob=robert bobby=robert dick=richard rick=richard jim=james jimmy=james mike=michael tom=thomas tommy=thomas dave=david dan=daniel danny=daniel eddie=edward ted=edward joe=joseph sam=samuel steve=stephen steven=stephen tony=anthony "
        "chris=christopher alex=alexander andy=andrew ben=benjamin charlie=charles fred=frederick greg=gregory jack=john johnny=john larry=lawrence matt=matthew nick=nicholas pat=patrick pete=peter ron=ronald tim=timothy liz=elizabeth beth=elizabeth betty=elizabeth kate=katherine kathy=katherine "
        "peggy=margaret meg=margaret sue=susan jen=jennifer jenny=jennifer"
    ).split()
)
# Old and other forms of the same character.
OLD_FORMS = dict(pair.split("=") for pair in "邊=辺 邉=辺 瀨=瀬 濱=浜 濵=浜 嶋=島 嶌=島 舘=館 桧=檜 槇=槙 澤=沢 瀧=滝 峯=嶺 阪=坂 燈=灯 藏=蔵 舩=船 船=舟 渕=淵 繩=縄 靏=鶴 鴈=雁 埜=野 眞=真 曉=暁 寍=寧 卋=世 羙=美 證=澄 斈=学 髙=高 﨑=崎".split())
# Lines of business and their usual Latin spellings.
BUSINESS = dict(
    pair.split("=")
    for pair in (
        "水産=suisan 観光=kanko ファーム=farm 電設=densetsu 印刷=insatsu 運輸=unyu 食品=shokuhin 商事=shoji メディカル=medical フーズ=foods 物産=bussan 不動産=fudosan 興業=kogyo 製菓=seika 化成=kasei システム=system 精機=seiki 建設=kensetsu ホールディングス=holdings 薬品=yakuhin "
        "工業=kogyou 製作所=seisakusho 銀行=bank 保険=hoken 電機=denki 通信=tsushin サービス=service 商会=shokai 製薬=seiyaku 出版=shuppan 書店=shoten 運送=unso 倉庫=soko"
    ).split()
)
# Company forms with their short marks, trades of small shops, courtesies and the like.
FORMS = {"株式会社": ["株", "kk", "k.k."], "有限会社": ["有"], "合同会社": ["同", "llc"], "医療法人": ["医"], "一般社団法人": ["一社", "社"], "一般財団法人": ["一財", "財"]}
SHOPS = ["食堂", "工房", "商店", "庵", "堂", "塾"]
AFTER = ["代表取締役社長", "代表取締役", "総務部", "法務部", "人事部", "御中", "先生", "さん", "様", "殿", "氏"]
_HIRAGANA, _KANJI = r"ぁ-ゖー", r"㐀-鿿々"


def _f(text: str) -> str:
    return one_form(pa.array([text])).to_pylist()[0].lower()


_FORM_WORDS = {_f(k): k for k in FORMS}
_MARKS = {_f(m): k for k, ms in FORMS.items() for m in ms}
_LONG = re.compile("|".join(map(re.escape, _FORM_WORDS)))
_NOTE = re.compile(r"\((?!(?:" + "|".join(re.escape(m) for m in _MARKS if not m.isascii()) + r")\))[^()]*\)")
_SHORT = re.compile(r"[㈱㈲㈳㈶]|(?:\(|(?<![本支]))(" + "|".join(re.escape(m) for m in _MARKS if not m.isascii()) + r")\)|(?<![a-z])(" + "|".join(re.escape(m) for m in _MARKS if m.isascii()) + r")(?![a-z])")
_SIGNS = {"㈱": "株式会社", "㈲": "有限会社", "㈳": "一般社団法人", "㈶": "一般財団法人"}
_TAIL = re.compile(r"(?:\s*(?:" + "|".join(_f(x) for x in AFTER) + r"|(?:ほか|外|他)\s*[0-9]+\s*名?|ほか|(?<=" + f"[{_KANJI}]" + r"{4})側|/\s*\S+|\([^()]*\)))+\s*$")
_BUSINESS = sorted(((_f(k), v) for k, v in BUSINESS.items()), key=lambda x: -len(x[0]))
# Other ways to write a line of business.
_HOLDINGS = {_f(k): v for k, v in {"hldgs": "holdings", "hd": "holdings", "ホールディング": "holdings", "システムズ": "system", "sys": "system", "フード": "foods", "メディカルズ": "medical", "ファームズ": "farm"}.items()}
_READ = {_f(k): v for k, v in READINGS.items()}
_WHOLE = {_f(k): v for k, v in WHOLE_NAMES.items()}
_WHOLE_NAME = re.compile("|".join(sorted(map(re.escape, _WHOLE), key=len, reverse=True)))


def spell(text: str) -> str:
    """Latin letters of a name part; small kana count as full ones, ends of sound that sound alike as one."""
    kana = "".join(_READ.get(c, c) for c in _WHOLE_NAME.sub(lambda m: _WHOLE[m.group()], to_hiragana(text)))
    if not kana.isascii():
        kana = kana.translate(str.maketrans("ぁぃぅぇぉゕゖをヵヶ", "あいうえおかけおかけ"))
    return re.sub(r"[^a-z㐀-鿿々]", "", loose_latin(romaji(kana)))


def spell_own(text: str) -> str:
    """Letters of an invented company name: small kana large, no length marks."""
    kana = re.sub(r"[^ぁ-ゖa-z㐀-鿿々]", "", to_hiragana(text)).translate(str.maketrans("ぁぃぅぇぉっゃゅょゎをゕゖ", "あいうえおつやゆよわおかけ"))
    return kana if kana.isascii() else romaji(kana)


def spell_core(text: str) -> str:
    """A company name's letters on one footing: syllables y + vowel after i-row sounds are one with their contracted spellings."""
    return re.sub(r"(?<=[kgnhbpmr])iy(?=[auo])", "y", re.sub(r"(?<=sh)iy(?=[auo])|(?<=ch)iy(?=[auo])|(?<=j)iy(?=[auo])", "", spell_own(text)))


def once(core: str) -> str:
    """A company name's spelling with doubled syllables written once."""
    return re.sub(r"((?:sh|ch|ts|[kgnhbpmr]y|[^aeioun]|n(?=[aeiou]))?[aeiou]|n)\1+", r"\1", core)


def consonants(part: str) -> str:
    """Phonetic code of a part: consonants by group, no vowels and breaths, no repeats."""
    head = re.sub(r"[aeiouyhw]", "", part.replace("sh", "s").replace("ch", "t").replace("ts", "t").replace("j", "z").replace("dz", "z"))
    return re.sub(r"(.)\1+", r"\1", head)


def block_codes(near: str) -> list[str]:
    """The codes of a spelling's sorted parts, and what any one consonant less leaves of them; the business after the bar stays."""
    head, bar, rest = near.partition("|")
    code = "-".join(sorted(consonants(p) for p in head.split()))
    return sorted({code + bar + rest, *(code[:i] + code[i + 1 :] + bar + rest for i in range(len(code)) if code[i] != "-")})


def analyse(form: str, slips: dict[str, str]) -> tuple[str, list[tuple[str, str]], str, str, str]:
    """``(kind, keys, core, business, company form)`` of a name in common form and lower case.

    kind 'firm' (keys with its business), 'core' (a firm's bare or cut name, no
    keys yet), 'kana' (person or bare firm), 'person', 'shop', or 'none'. A key goes with
    the spelling that is compared: sorted parts, or a company's own name and business.
    """
    t = _NOTE.sub(" ", form)
    t = re.sub(r"co\.?,?\s*ltd\.?|\binc\.?$|\bcorp\.?$", " ltd ", t)
    mark = ""
    found = _LONG.search(t)
    if found:
        mark, t = _FORM_WORDS[found.group()], t[: found.start()] + " " + t[found.end() :]
    found = _SHORT.search(t)
    if found:
        mark = mark or _SIGNS.get(found.group()) or _MARKS[found.group(1) or found.group(2)]
        t = t[: found.start()] + " " + t[found.end() :]
    ltd = " ltd " in t
    t = _TAIL.sub("", t.replace(" ltd ", " ")).strip()
    t = "".join(slips.get(c, OLD_FORMS.get(c, c)) for c in t)
    bare = re.sub(r"[^\w]", "", t)
    if not bare or bare.isdigit():
        return "none", [], "", "", mark
    if bare.isascii():
        words = t.split()
        for _, latin in _BUSINESS:
            # of several words the last must be the business; else a given name could end like one
            if (words[-1] == latin if len(words) > 1 else bare.endswith(latin)) and len(bare) > len(latin) + 1:
                return _firm(bare[: -len(latin)], latin, mark)
        if mark or ltd:
            return "core", [], spell_core(bare), "", mark
        return ("person", *_person(t), "", "", mark)
    for long, short in _HOLDINGS.items():
        if bare.endswith(long) and len(bare) > len(long) + 1:
            return _firm(bare[: -len(long)], short, mark)
    kana_name = re.match(rf"[ァ-ヺぁ-ゖー]{{2,}}", bare)
    for word, latin in _BUSINESS:
        if bare.endswith(word) and len(bare) > len(word) + 1 and (mark or kana_name):
            return _firm(bare[: -len(word)], latin, mark)
    for shop in SHOPS:
        if kana_name and bare.endswith(_f(shop)):
            return "shop", [(f"{spell_core(bare[: -len(shop)])}|{shop}", f"{spell_own(bare[: -len(shop)])}|{shop}")], "", "", mark
    if kana_name or mark:
        if bare.endswith("社") and len(bare) > 3:
            return "core", [], spell_core(bare[:-1]), "", mark
        for word, latin in _BUSINESS:  # a line of business cut short
            for cut in range(len(word) - 1, 0 if re.match(f"[{_KANJI}]", word) else 2, -1):
                if bare.endswith(word[:cut]) and len(bare) > cut + 1:
                    return "core", [], spell_core(bare[:-cut]), word[:cut], mark
        if mark:
            return "core", [], spell_core(bare), "", mark
        if re.fullmatch(r"[ァ-ヺぁ-ゖー]+", bare):
            return ("kana", *_person(t), spell_core(bare), "", mark)
    return ("person", *_person(t), "", "", mark)


def _firm(own: str, business: str, mark: str) -> tuple[str, list[tuple[str, str]], str, str, str]:
    core = spell_core(own)
    return "firm", [(f"{core}|{business}", f"{spell_own(own)}|{business}")], core, business, mark


def _person(t: str) -> tuple[list[tuple[str, str]]]:
    parts = [p for p in re.split(r"[^\w]+", t) if p]
    if len(parts) > 1:
        parts = [NICKNAMES.get(p, p) for p in parts]
    else:
        one = parts[0]
        begin = _WHOLE_NAME.match(one)
        turn = re.fullmatch(rf"([{_KANJI}]+)([ァ-ヺぁ-ゖー]+)|([ァ-ヺぁ-ゖー]+)([{_KANJI}]+)", one)
        if begin and begin.end() < len(one) and not re.search(r"[a-z]", one):
            parts = [begin.group(), one[begin.end() :]]
        elif turn:
            parts = [g for g in turn.groups() if g]
        elif re.fullmatch(rf"[{_KANJI}]{{3,5}}", one):
            keys = {frozenset((one[:2], one[2:])), frozenset((one[-2:], one[:-2]))}
            return ([k for pair in keys for k in _orders(sorted(pair))],)
    return (_orders(parts),)


def _orders(parts: list[str]) -> list[tuple[str, str]]:
    spelt = [s for s in map(spell, parts) if s]
    near = " ".join(sorted(spelt))
    return sorted({("".join(spelt), near), ("".join(reversed(spelt)), near)}) if near else []


def near_pairs(a: list[str], b: list[str], firm: float, added: float, part: float, whole: float) -> np.ndarray:
    """True for spellings of one block that Jaro-Winkler takes for one name.

    Companies of one business: their own names reach ``firm``, or ``added`` if one is the other with sounds written twice.
    Persons: as many parts, each ``part`` or more in the better order, and ``whole`` over all.
    """
    out = np.zeros(len(a), dtype=bool)
    cores = [k for k, x in enumerate(a) if "|" in x]
    if cores:
        x, y = [a[k].partition("|")[0] for k in cores], [b[k].partition("|")[0] for k in cores]
        v = D.jaro_winkler(x, y)
        twice = np.array([consonants(p) == consonants(q) for p, q in zip(x, y)], dtype=bool)
        out[cores] = (v >= firm) | ((v >= added) & twice & D.only_added(x, y))
    ask = [k for k, (x, y) in enumerate(zip(a, b)) if "|" not in x and x.count(" ") == y.count(" ")]
    if ask:
        v = D.jaro_winkler([a[k].replace(" ", "") for k in ask], [b[k].replace(" ", "") for k in ask])
        ask = [k for k, ok in zip(ask, v >= whole) if ok]
    if ask:
        rows = [(k, turn, x, y) for k in ask for turn, right in enumerate((b[k].split(), b[k].split()[::-1])) for x, y in zip(a[k].split(), right)]
        frame = pd.DataFrame(rows, columns=["k", "turn", "x", "y"])
        frame["v"] = D.jaro_winkler(frame["x"].tolist(), frame["y"].tolist())
        least = frame.groupby(["k", "turn"])["v"].min().groupby("k").max()
        out[least.index[least >= part]] = True
    return out


def client_links(rows: DataFrame, *, firm: float = 0.93, added: float = 0.91, part: float = 0.9, whole: float = 0.95, spread: int = 3, remark_kinds: tuple[str, ...] = ("補足", "当事者/区分")) -> DataFrame:
    """``(row, client)``: the client each row stands for, named by a key of its component.

    ``rows``: ``row``, ``name`` (the client as typed), ``alias`` (another name of the
    client or null) and ``kind`` of the alias. Aliases of the remark kinds, and those
    given to ``spread`` or more different clients, are remarks and link nothing. A row
    whose name cannot be read stays alone. Null rows are dropped, repeated rows count
    once, an empty table gives none.
    """
    base = materialize(rows.where("row is not null and (name is not null or alias is not null)").select("row", "name", "alias", "kind").distinct(), "rows")
    wanted = F.col("alias").isNotNull() & ~F.coalesce(F.col("kind").isin(*remark_kinds), F.lit(False))
    said = base.select("row", F.explode(F.array(F.struct(F.col("name").alias("text"), F.lit(0).alias("side")), F.struct(F.when(wanted, F.col("alias")).alias("text"), F.lit(1).alias("side")))).alias("s")).select("row", "s.text", "s.side").where("text is not null")
    names = materialize(with_form(said.select("text").distinct(), "text").select("text", F.lower("form").alias("form")), "names")

    # stray characters: the known one they replace in most four-character names
    known = "".join(_READ)
    four = names.select(F.regexp_replace("form", r"[^\p{L}\p{N}]", "").alias("n")).where(rf"n rlike '^[{_KANJI}]{{4}}$'").distinct()
    holes = four.select("n", F.length(F.translate("n", known, "")).alias("odd"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("i")).select(
        "n", "odd", F.substring("n", F.col("i"), F.lit(1)).alias("c"), F.concat_ws("_", F.expr("substring(n, 1, i - 1)"), F.expr("substring(n, i + 1)")).alias("hole")
    )
    stray = holes.where((F.col("odd") == 1) & ~F.col("c").isin(*_READ)).select("hole", F.col("c").alias("u"), "n")
    meant = stray.join(holes.where("odd = 0").select("hole", F.col("c").alias("meant")), "hole").groupBy("u", "meant").agg(F.count_distinct("n").alias("k"))
    far = F.abs(F.ascii("u") - F.ascii("meant"))
    # one row a character of the script, so this stays small at any size
    slips = {r["u"]: r["m"] for r in meant.groupBy("u").agg(F.max(F.struct("k", (-far).alias("near"), "meant"))["meant"].alias("m")).collect()}

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(text, *analyse(form, slips)) for text, form in pdf.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["text", "what", "spelt", "core", "business", "mark"])

    parts = names.mapInPandas(taken, "text string, what string, spelt array<struct<key: string, near: string>>, core string, business string, mark string")
    parts = materialize(parts.withColumn("keys", F.transform("spelt", lambda x: x["key"])), "parts")
    @F.pandas_udf("string")
    def folded(cores: pd.Series) -> pd.Series:
        return cores.map(once)

    # a bare or cut company name stands for the one firm of that name, of the same company form if it names one
    firms = parts.where("what = 'firm'").groupBy(folded("core").alias("core"), "business").agg(F.collect_set(F.nullif("mark", F.lit(""))).alias("marks"), F.min("core").alias("own"))
    words = F.create_map(*[F.lit(x) for latin, word in ((v, k) for k, v in BUSINESS.items()) for x in (latin, _f(word))])
    bare = parts.where("what in ('core', 'kana') and core <> ''").select("text", folded("core").alias("core"), F.col("business").alias("cut"), "mark")
    fits = bare.join(firms, "core").where((F.col("cut") == "") | F.coalesce(words[F.col("business")].startswith(F.col("cut")), F.lit(False)))
    fits = fits.withColumn("form_fits", (F.col("mark") == "") | F.array_contains("marks", F.col("mark")) | (F.size("marks") == 0)).withColumn("key", F.concat_ws("|", "own", "business"))
    fitting = F.when(F.col("form_fits"), F.col("key"))
    one = fits.groupBy("text").agg(F.count_distinct("key").alias("n"), F.min("key").alias("k"), F.count_distinct(fitting).alias("n2"), F.min(fitting).alias("k2"))
    resolved = one.select("text", F.when(F.col("n") == 1, F.col("k")).when(F.col("n2") == 1, F.col("k2")).alias("firm"), F.lit(True).alias("of_firm"))
    keyed = parts.join(resolved, "text", "left").select(
        "text", F.when(F.col("firm").isNotNull(), F.array("firm")).when((F.col("what") == "kana") & F.col("of_firm"), F.array().cast("array<string>")).otherwise(F.col("keys")).alias("keys")
    )
    links = materialize(said.join(keyed, "text").select("row", "side", F.explode("keys").alias("key")).distinct(), "links")
    # names given to many clients are remarks
    owner = links.where("side = 0").groupBy("row").agg(F.min("key").alias("owner"))
    remarks = links.where("side = 1").join(owner, "row").groupBy("key").agg(F.count_distinct("owner").alias("n")).where(F.col("n") >= spread).select("key", F.lit(1).alias("side"))
    links = materialize(links.join(remarks, ["key", "side"], "left_anti"), "links")
    edges = links.groupBy("row").agg(F.min("key").alias("a")).join(links.select("row", F.col("key").alias("b")), "row").select("a", "b")

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(near_pairs(a.tolist(), b.tolist(), firm, added, part, whole))

    @F.pandas_udf("array<string>")
    def codes(near: pd.Series) -> pd.Series:
        return near.map(block_codes)

    keys = links.select("key").distinct()
    # a spelling that someone wrote in characters throughout is told apart from any other such one
    written = F.col("what").eqNullSafe("person") & F.col("text").rlike(f"[{_KANJI}]")
    spelt = parts.select(F.explode("spelt").alias("s"), written.alias("written")).select("s.key", "s.near", "written").where("near rlike '^[a-z |]+([|].*)?$'").join(keys, "key", "left_semi")
    spelt = materialize(spelt.groupBy("near").agg(F.min("key").alias("key"), F.bool_or("written").alias("written")), "spelt")
    coded = spelt.select("near", "written", F.explode(codes("near")).alias("code"))
    met = coded.join(coded.select("code", F.col("near").alias("other"), F.col("written").alias("other_written")), "code").where("near < other and not (written and other_written)").select("near", "other", "written", "other_written").distinct()
    close = materialize(met.where(alike("near", "other")), "near")
    # a spelling near several written ones names none of them; one near a written one goes with that alone
    typed = close.select(F.when(F.col("written"), F.col("other")).otherwise(F.col("near")).alias("typed"), F.when(F.col("written"), F.col("near")).otherwise(F.col("other")).alias("kept"), (F.col("written") | F.col("other_written")).alias("sure"))
    wanted = typed.where("sure").groupBy("typed").agg(F.count(F.lit(1)).alias("n"), F.min("kept").alias("kept"))
    loose = typed.where("not sure").join(wanted.select("typed"), "typed", "left_anti").join(wanted.select(F.col("typed").alias("kept")), "kept", "left_anti")
    pairs = wanted.where("n = 1").select("typed", "kept").union(loose.select("typed", "kept"))
    of = lambda c, n: spelt.select(F.col("near").alias(c), F.col("key").alias(n))
    near = pairs.join(of("typed", "a"), "typed").join(of("kept", "b"), "kept").select("a", "b")
    clients = connected_components(edges.union(near).union(keys.select(F.col("key").alias("a"), F.col("key").alias("b"))))
    of_rows = links.join(clients.withColumnRenamed("node", "key"), "key").groupBy("row").agg(F.min("component").alias("client"))
    return of_rows


def same_client_pairs(links: DataFrame) -> DataFrame:
    """``(key_a, key_b)``: each pair of rows of one client."""
    other = links.select("client", F.col("row").alias("key_b"))
    return links.join(other, "client").where("row < key_b").select(F.col("row").alias("key_a"), "key_b")
