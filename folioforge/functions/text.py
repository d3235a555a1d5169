"""Column functions for titles, publishers, readings, numbers and similarity.

Built-in expressions wherever Spark has them; Unicode normal forms, sequence
matching and kanji numerals are Arrow UDFs.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))
HIRAGANA = "".join(chr(c - 0x60) for c in range(0x30A1, 0x30F7))
WIDE_ALNUM = "".join(map(chr, [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]))
NARROW_ALNUM = "".join(chr(ord(c) - 0xFEE0) for c in WIDE_ALNUM)
# What each title key drops. The two keys differ on purpose.
TOC_TITLE_DROPS = r"[\s　・･·:：,，()（）\[\]［］「」『』【】'\"’”“‘./&＆\-－ー―‐–—]"
SHOP_TITLE_DROPS = r"[\s　・･·:：;；,，、。.!！?？~〜～\\/()（）\[\]［］「」『』【】〔〕〈〉'\"’”“‘&＆\-－―‐–—]"
# Forms of companies (in compatibility form), then the signs that a publisher's key drops.
COMPANY_FORMS = r"(独立行政法人|一般財団法人|一般社団法人|公益財団法人|公益社団法人|株式会社|有限会社|合同会社|合名会社|合資会社|財団法人|社団法人|\(株\)|\(有\)|\(財\)|\(社\)|\(同\)|\(資\)|\(名\))"
PUBLISHER_DROPS = r"[\s　・･:：,，、_\-\(\)\[\]【】「」『』“”\"'./&＆ー―−‐‑‒–—]+"
# Styles of numbering (name, pattern), the first that a title shows counts.
NUMBERING = [
    ("kanji_chapter", r"第[0-9０-９]+[章編節]"),
    ("kanji_num", r"第[一二三四五六七八九十百]+[章編節]"),
    ("roman", r"^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]"),
    ("article", r"(?i)(article|art\.)\s*\d+"),
    ("arabic", r"^[0-9０-９]+[\.\s　]"),
]
# Other names of the two page bases.
PRINT_PAGES = ["print_page", "print", "paper", "本文ページ", "印刷ページ"]
PDF_PAGES = ["pdf_page", "pdf", "image", "通しページ"]
# What the parts of a request and its answer add to a file's stem.
ROLE_SUFFIX = r"(?i)[_\-]?(request|result|response|reply|answer|req|res|out|in|送信|戻り|依頼|回答)$"


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition; nulls stay null."""
    return texts.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition; nulls stay null."""
    return texts.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def narrow(col: Column) -> Column:
    """Full-width letters and digits to ASCII, in the JVM."""
    return F.translate(col, WIDE_ALNUM, NARROW_ALNUM)


def hiragana(col: Column) -> Column:
    return F.translate(col, KATAKANA, HIRAGANA)


def toc_title_key(col: Column, wide: bool = True) -> Column:
    """Title key of outline nodes: compatibility form, lower case, without blanks and most signs."""
    return F.regexp_replace(F.lower(nfkc(col) if wide else col), TOC_TITLE_DROPS, "")


def shop_title_key(col: Column, wide: bool = True) -> Column:
    """Title key of the purchase recommender, with its wider list of dropped signs."""
    return F.regexp_replace(F.lower(nfkc(col) if wide else col), SHOP_TITLE_DROPS, "")


def search_key(col: Column, wide: bool = True) -> Column:
    """Search form: compatibility form, lower case, hiragana."""
    return hiragana(F.lower(nfkc(col) if wide else col))


def loose_key(col: Column) -> Column:
    """A search form without any blank."""
    return F.regexp_replace(col, r"[\s　]", "")


def preferred_key(col: Column) -> Column:
    """Term key: canonical form, trimmed, ASCII letters and digits."""
    return narrow(F.trim(nfc(col)))


def reading_key(col: Column) -> Column:
    """Reading key: hiragana without blanks, middle dots and length marks."""
    return F.regexp_replace(hiragana(nfkc(col)), r"[\s　・ー]", "")


def publisher_key(col: Column, wide: bool = True) -> Column:
    """Publisher key: company forms go first, then signs and blanks."""
    base = F.lower(nfkc(col) if wide else col)
    return F.regexp_replace(F.regexp_replace(base, COMPANY_FORMS, ""), PUBLISHER_DROPS, "")


def isbn_light(col: Column) -> Column:
    """Digits and X only."""
    return F.upper(F.regexp_replace(narrow(col), "[^0-9Xx]", ""))


def isbn13(col: Column) -> Column:
    """13 digits pass, 10 become 978 with a new check digit, anything else is empty text."""
    raw = isbn_light(col)
    body = F.concat(F.lit("978"), F.substring(raw, 1, 9))
    total = sum((F.substring(body, i + 1, 1).try_cast("int") * (3 if i % 2 else 1) for i in range(12)), F.lit(0))
    check = F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")
    return F.when(raw.rlike("^[0-9]{13}$"), raw).when(raw.rlike("^[0-9]{9}[0-9X]$"), F.concat(body, check)).otherwise("")


def first_year(col: Column) -> Column:
    """The first four digits in a row, else empty text."""
    return F.coalesce(F.regexp_extract(narrow(col.cast("string")), "([0-9]{4})", 1), F.lit(""))


def year_state(col: Column) -> Column:
    """``struct(value, state)``: state is ok, missing or parse_error; four digits that no digit touches are a year."""
    value = F.regexp_extract(narrow(col), r"(?<![0-9])([0-9]{4})(?![0-9])", 1)
    blank = col.isNull() | (F.trim(col) == "")
    return F.struct(F.when(~blank & (value != ""), value.try_cast("int")).alias("value"), F.when(blank, "missing").when(value == "", "parse_error").otherwise("ok").alias("state"))


def numbering_scheme(col: Column) -> Column:
    """The style of numbering that a heading shows; null for none."""
    out = F
    for name, pattern in NUMBERING:
        out = out.when(col.rlike(pattern), name)
    return out.otherwise(None)


def size_bucket(n: Column) -> Column:
    """Size of an outline: empty, 1-10, 11-50, 51+."""
    return F.when(n == 0, "empty").when(n <= 10, "1-10").when(n <= 50, "11-50").otherwise("51+")


def member_bucket(n: Column) -> Column:
    """Size of a section or group in reports: 1, 2-5, 6-20, 21+."""
    return F.when(n <= 1, "1").when(n <= 5, "2-5").when(n <= 20, "6-20").otherwise("21+")


def page_basis(col: Column) -> Column:
    """print_page, pdf_page or unknown."""
    low = F.lower(F.trim(col))
    return F.when(low.isin(PRINT_PAGES), "print_page").when(low.isin(PDF_PAGES), "pdf_page").otherwise("unknown")


def to_print_page(pdf_page: Column, offset: Column) -> Column:
    """The printed number of a page of the file; the offset is file page less printed page."""
    return pdf_page - offset


def to_pdf_page(print_page: Column, offset: Column) -> Column:
    return print_page + offset


def journal_key(col: Column, aliases: dict[str, str] | None = None) -> Column:
    """Journal name with ASCII digits and no blanks, then its usual name if it is an alias; null is empty text."""
    bare = F.regexp_replace(F.translate(F.coalesce(col, F.lit("")), "０１２３４５６７８９", "0123456789"), "[ 　]", "")
    bare = F.trim(bare)
    if not aliases:
        return bare
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]), bare), bare)


def locator_parts(col: Column) -> Column:
    """``struct(journal, issue, page)`` of ``[journal_article:]J:I:P``; null unless journal and issue say something and a page part is there."""
    parts = F.split(F.regexp_replace(col, "^journal_article:", ""), ":")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    good = (F.size(parts) >= 3) & (at(1) != "") & (at(2) != "")
    return F.when(good, F.struct(at(1).alias("journal"), at(2).alias("issue"), at(3).alias("page")))


def role_stem(col: Column) -> Column:
    """A file's stem without the part it plays, so that a request and its answer share a key."""
    return F.regexp_replace(col, ROLE_SUFFIX, "")


def folder_name(path: Column) -> Column:
    """The folder a file lies in; empty text for a bare name."""
    parts = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda x: x != "")
    return F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2))).otherwise("")


def cited_journal(col: Column, wide: bool = True) -> Column:
    """The journal at the head of a citation: what stands before the first digit, without quotes, blanks and signs at its ends."""
    text = F.coalesce(nfkc(col) if wide else col, F.lit(""))
    head = F.split(F.regexp_replace(text, r"^[『「（(]+", ""), "[0-9]").getItem(0)
    return F.trim(F.regexp_replace(F.regexp_replace(head, r"^[ 　,，、。.・（(「『]+|[ 　,，、。.・（(「『]+$", ""), r"\s+", " "))


def markdown_cell(col: Column) -> Column:
    """A text that may stand in a cell of a table: bars escaped, line breaks as blanks; null is empty."""
    return F.regexp_replace(F.replace(F.coalesce(col, F.lit("")), F.lit("|"), F.lit("\\|")), r"[\r\n]+", " ")


def article_root(col: Column) -> Column:
    """An article path without its paragraph and item."""
    return F.split(col, ":(?:para|item):").getItem(0)


def bigrams(col: Column) -> Column:
    """The set of two-character pieces; a single character is its own piece."""
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.length(col) - 1, F.lit(1))), lambda i: F.substring(col, i, F.lit(2)))
    return F.when(F.length(col) > 0, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two sets; two empty sets are alike, an empty and a filled one are not."""
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ == 0, F.lit(1.0)).otherwise(both / any_)


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller set that the other holds; 0 where one is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / least)


def stable_hash(*cols: Column) -> Column:
    """md5 of values joined by the unit separator, nulls as chr(1), so null and empty differ."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x01")) for c in cols]))


def sequence_ratio(a: str, b: str) -> float:
    """Ratio of a sequence match; its cheap upper bounds stand in where they are below 0.6. Two empty texts are alike."""
    if not a and not b:
        return 1.0
    m = difflib.SequenceMatcher(None, a, b)
    for bound in (m.real_quick_ratio(), m.quick_ratio()):
        if bound < 0.6:
            return bound
    return m.ratio()


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([sequence_ratio(x, y) if x is not None and y is not None else None for x, y in zip(a, b)])


_DIGIT = {c: i for i, c in enumerate("〇一二三四五六七八九")} | {"零": 0}


def small_kanji_value(text: str | None) -> int | None:
    """Number of an edition in digits or kanji up to 99; None if it is none."""
    if not text:
        return None
    if text.isdigit():
        return int(text)
    tens, ten, ones = text.partition("十")
    digit = lambda t, empty: empty if not t else _DIGIT.get(t)
    a, b = (digit(tens, 1), digit(ones, 0)) if ten else (0, digit(tens, None))
    return None if a is None or b is None else 10 * a + b


def kanji_value(text: str | None) -> int | None:
    """Number in digits or kanji up to thousands; None if it is none."""
    if not text:
        return None
    text = unicodedata.normalize("NFKC", text)
    if text.isdigit():
        return int(text)
    total, current = 0, 0
    for c in text:
        if c in _DIGIT:
            current = current * 10 + _DIGIT[c]
        elif c in "十百千":
            total += (current or 1) * {"十": 10, "百": 100, "千": 1000}[c]
            current = 0
        else:
            return None
    return total + current


@F.pandas_udf(T.IntegerType())
def kanji_number(texts: pd.Series) -> pd.Series:
    return texts.map(kanji_value).astype("Int32")
