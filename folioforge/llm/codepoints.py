"""One form for text that looks the same: whole Arrow columns as code-point arrays.

A column's bytes become one array of code points. A lookup table gives each code
point its expansion (width, compatibility forms that look alike, look-alike
letters and signs, blanks, nothing for invisible ones); the expansions are
gathered with offsets, combining marks are put in canonical order and composed
by searching a sorted table of pairs, round by round over the whole column. No
string is handled by itself.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of other scripts or blocks that look like the one they are mapped to.
LOOKALIKE = {
    # Greek and Cyrillic capitals
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    # Greek and Cyrillic small letters
    "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɑ": "a", "ɡ": "g",
    # kanji and kana drawn alike
    "工": "エ", "力": "カ", "夕": "タ", "卜": "ト", "二": "ニ", "八": "ハ", "口": "ロ", "へ": "ヘ", "べ": "ベ", "ぺ": "ペ",
    # short dashes; long dashes and the length mark
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "⁃": "-", "﹣": "-",
    "—": "ー", "―": "ー", "─": "ー", "━": "ー", "一": "ー",
    # other signs
    "〜": "~", "∼": "~", "˜": "~", "·": "・", "•": "・", "‧": "・", "∙": "・", "⋅": "・", "∶": ":", "꞉": ":",
    "‘": "'", "’": "'", "′": "'", "ʼ": "'", "´": "'", "`": "'", "“": '"', "”": '"', "″": '"', "⁄": "/", "∕": "/", "╱": "/", "ǀ": "|", "‹": "<", "›": ">",
}
#: tags of compatibility decompositions that keep the look; circled, raised, squared and fraction forms look different
_SAME_LOOK = {"<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>"}
_BLANKS = {0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85}
_INVISIBLE = [(0x034F, 0x034F), (0x180B, 0x180F), (0xFE00, 0xFE0F), (0xE0000, 0xE0FFF)]
_TOP = 0x110000


def _expand(ch: str, depth: int = 0) -> str:
    """The full decomposition of a character that keeps its look."""
    tag = unicodedata.decomposition(ch)
    if tag:
        parts = tag.split()
        if parts[0][0] == "<":
            kept = parts[0] in _SAME_LOOK and not (len(parts) > 2 and parts[1] in ("0020", "0028"))
            parts = parts[1:] if kept else []
        if parts:
            return "".join(_expand(chr(int(x, 16)), depth + 1) for x in parts)
    swapped = LOOKALIKE.get(ch)
    return _expand(swapped, depth + 1) if swapped and depth < 8 else ch


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, pool, classes, pair keys, pair results)``."""
    start, length = np.arange(_TOP, dtype=np.int32), np.ones(_TOP, dtype=np.int32)
    classes = np.zeros(_TOP, dtype=np.uint8)
    pool, keys, made = list(range(_TOP)), [], []
    for code in [*range(0x30000), *range(0xE0000, 0xE1000)]:
        if 0xD800 <= code <= 0xDFFF or 0x4E00 <= code <= 0x9FFF and chr(code) not in LOOKALIKE or 0xAC00 <= code <= 0xD7A3:
            continue
        ch = chr(code)
        kind = unicodedata.category(ch)
        classes[code] = unicodedata.combining(ch)
        if code in _BLANKS or kind in ("Zs", "Zl", "Zp"):
            to = " "
        elif kind in ("Cf", "Cc") or any(a <= code <= b for a, b in _INVISIBLE):
            to = ""
        else:
            to = _expand(ch)
        if to != ch:
            start[code], length[code] = len(pool), len(to)
            pool += map(ord, to)
        canonical = unicodedata.decomposition(ch)
        if canonical and canonical[0] != "<" and " " in canonical and unicodedata.normalize("NFC", ch) == ch:
            a, b = (int(x, 16) for x in canonical.split())
            keys.append(a << 21 | b)
            made.append(code)
    order = np.argsort(keys)
    return start, length, np.array(pool, dtype=np.int32), classes, np.array(keys, dtype=np.int64)[order], np.array(made, dtype=np.int32)[order]


def _pairs(a: np.ndarray, b: np.ndarray, keys: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Composition of each pair, -1 where there is none; Hangul by arithmetic."""
    want = a.astype(np.int64) << 21 | b
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    out = np.where(keys[at] == want, made[at], -1)
    lead, vowel, s = a - 0x1100, b - 0x1161, a - 0xAC00
    out = np.where((lead >= 0) & (lead < 19) & (vowel >= 0) & (vowel < 21), 0xAC00 + (lead * 21 + vowel) * 28, out)
    return np.where((s >= 0) & (s < 11172) & (s % 28 == 0) & (b > 0x11A7) & (b < 0x11C3), a + b - 0x11A7, out)


def _compose(codes: np.ndarray, row: np.ndarray, classes: np.ndarray, keys: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cc = classes[codes]
    if cc.any():  # canonical order: a stable sort by class within runs of a starter and its marks
        begins = np.concatenate([[True], row[1:] != row[:-1]])
        order = np.lexsort((cc, np.cumsum((cc == 0) | begins)))
        codes, row = codes[order], row[order]
    while True:
        n = len(codes)
        cc = classes[codes]
        at = np.arange(n)
        starter = np.maximum.accumulate(np.where(cc == 0, at, -1))
        base = np.where(cc == 0, at - 1, starter)  # a starter may join only the starter right before it
        prev = np.concatenate([[0], cc[:-1]])
        free = (base >= 0) & np.where(cc == 0, prev == 0, (at - 1 == base) | (prev < cc))
        free[0:1] = False
        i = np.flatnonzero(free)
        i = i[row[base[i]] == row[i]]
        got = _pairs(codes[base[i]], codes[i], keys, made)
        i, got = i[got >= 0], got[got >= 0]
        if not len(i):
            return codes, row
        _, first = np.unique(base[i], return_index=True)
        i, got = i[first], got[first]
        # a character that is itself consumed this round cannot also be a base
        keep = ~np.isin(base[i], i)
        i, got = i[keep], got[keep]
        codes = codes.copy()
        codes[base[i]] = got
        alive = np.ones(n, dtype=bool)
        alive[i] = False
        codes, row = codes[alive], row[alive]


def one_form(column: pa.Array) -> pa.Array:
    """The common form of each text. Nulls stay null; texts of invisible characters alone become empty."""
    column = column.cast(pa.large_string()).combine_chunks() if isinstance(column, pa.ChunkedArray) else column.cast(pa.large_string())
    n = len(column)
    if not n:
        return column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.int32)
    # bytes that start a code point; their running count turns byte offsets into code-point offsets
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    row = np.repeat(np.arange(n), np.diff(heads[offsets]))
    start, length, pool, classes, keys, made = tables()
    size = length[codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    source = np.repeat(start[codes] - (ends - size), size) + np.arange(total)
    codes, row = _compose(pool[source], np.repeat(row, size), classes, keys, made)
    # code points back to bytes: their widths give the new offsets
    width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    out = np.zeros(n + 1, dtype=np.int64)
    out[1:] = np.cumsum(np.bincount(row, weights=width, minlength=n).astype(np.int64))
    data = codes.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    valid = None if not column.null_count else pa.py_buffer(np.packbits(~np.asarray(column.is_null()), bitorder="little").tobytes())
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(out.tobytes()), pa.py_buffer(data), valid, column.null_count).cast(pa.string())


def with_form(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """Adds ``out``, the common form of the text column; a map over Arrow batches without a shuffle."""
    if out in df.columns:
        raise ValueError(f"column {out} is taken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, one_form(batch.column(batch.schema.get_field_index(text)))], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def lookalike_pairs(rows: DataFrame, *, scope: list[str], key: str, text: str) -> DataFrame:
    """``(*scope, key_a, key_b)``: keys of one scope whose texts differ but have one form.

    Rows with a null key or text are no case, a key with several texts takes part
    with each, repeated rows count once, an empty table gives no pairs. Joins are on
    the form's hashes; rows of equal texts never meet.
    """
    from folioforge.runtime import materialize

    named = rows.select(*scope, F.col(key).alias("key"), F.col(text).alias("raw")).where("key is not null and raw is not null")
    slim = materialize(
        with_form(named, "raw").select(*scope, "key", F.xxhash64("raw").alias("r"), F.xxhash64(*scope, "form").alias("h"), F.hash("form").alias("h2")),
        "forms",
    )
    # variants of a form are paired with each other first; a key then meets only keys of other variants,
    # so the rows joined are the pairs that the result has
    variants = slim.select("h", "h2", "r").distinct()
    mixed = variants.join(variants.select("h", "h2", F.col("r").alias("r_b")), ["h", "h2"]).where("r < r_b")
    part = slim.distinct()
    left = part.join(mixed, ["h", "h2", "r"]).select(*scope, "key", "h", "h2", F.col("r_b").alias("r"))
    pairs = left.join(part.select("h", "h2", "r", F.col("key").alias("other")), ["h", "h2", "r"]).where("key <> other")
    return pairs.select(*scope, F.least("key", "other").alias("key_a"), F.greatest("key", "other").alias("key_b")).distinct()
