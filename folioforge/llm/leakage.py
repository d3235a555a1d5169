"""Evaluation texts that leaked into a corpus, by Wu-Manber multi-pattern search.

The test strings are all windows of ``WINDOW`` letters of the held-out passages. A
shift table over blocks of two letters says how far a scan may skip; where no
skip is possible, a bucket of the strings with the same suffix hash is compared
directly. All segments of a batch are scanned in step, each at its own pace, with
array operations. Hits that line up on nearby diagonals name a passage and a
stretch of text; a local alignment of the two decides, so that misread, missing
and added letters do not hide a passage and shared phrases of the same style do
not make one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.codepoints import one_form

WINDOW, BLOCK, SUFFIX, SEGMENT = 7, 2, 3, 256
#: slots of the shift table; blocks that share one share the least of their shifts, which costs time and no occurrence
SHIFT_BITS = 20
#: cells of one array of the alignments
ALIGN_CELLS = 2_000_000
PASS_CHARS = 150_000
#: letters of one block of passages; longer lists are searched block by block
BLOCK_LETTERS = 400_000
ERROR = 3
#: letters beyond a run, on either side, that its alignment looks at
REACH = 64
#: share of the wanted score that exact windows on one diagonal must cover before letters are aligned
SEED_SHARE = 0.65


class Patterns(NamedTuple):
    """The compiled test strings of one block of passages."""

    ids: np.ndarray  # code point -> letter id, 0 for letters of no passage
    size: int
    shift: np.ndarray  # hashed pair of letter ids -> how far to move on; 2 ** SHIFT_BITS bytes for any alphabet
    suffixes: np.ndarray  # sorted suffix hashes, one a string
    strings: np.ndarray  # (strings, WINDOW) letter ids in the order of the suffixes
    first: np.ndarray  # string -> its first posting
    item: np.ndarray  # postings: passage
    offset: np.ndarray  # postings: place in the passage
    letters: list[np.ndarray]
    keys: list


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits of the texts' common forms in lower case, as code points, and where each text begins."""
    forms = one_form(pa.array(texts, pa.string())).to_pylist()
    low = [x.lower() for x in forms]
    codes = np.frombuffer("".join(low).encode("utf-32-le"), dtype=np.int32)
    row = np.repeat(np.arange(len(low)), [len(x) for x in low])
    keep = _is_letter()[np.minimum(codes, 0x2FFFF)]
    codes, row = codes[keep], row[keep]
    return codes, np.searchsorted(row, np.arange(len(low) + 1))


_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalnum() and not 0xD800 <= c <= 0xDFFF for c in range(0x30000)), dtype=bool, count=0x30000))
    return _LETTERS[0]


def _hash(rows: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(rows), dtype=np.int64)
    for j in range(rows.shape[1]):
        out = out * size + rows[:, j]
    return out


def _halves(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a letter id adds to the slot of a block that it begins, and of one that it ends."""
    with np.errstate(over="ignore"):
        wide = ids.astype(np.uint32)
        return wide * np.uint32(0x9E3779B1), wide * np.uint32(0x85EBCA77)


def _slot(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Slot of a block of two letters, from their halves."""
    return (begins ^ ends) >> np.uint32(32 - SHIFT_BITS)


def compile_patterns(keys: list, texts: list[str]) -> Patterns | None:
    """Shift table, suffix buckets and postings; None where no passage has a window of letters."""
    codes, at = letters_of(texts)
    parts = [codes[at[i] : at[i + 1]] for i in range(len(texts))]
    alphabet = np.unique(codes)
    ids = np.zeros(0x30000, dtype=np.int32)
    ids[alphabet] = np.arange(1, len(alphabet) + 1)
    size = len(alphabet) + 1
    rows, item, offset = [], [], []
    for n, part in enumerate(parts):
        if len(part) >= WINDOW:
            w = np.lib.stride_tricks.sliding_window_view(ids[part], WINDOW)
            rows.append(w)
            item.append(np.full(len(w), n))
            offset.append(np.arange(len(w)))
    if not rows:
        return None
    strings, back = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    shift = np.full(1 << SHIFT_BITS, WINDOW - BLOCK + 1, dtype=np.int8)
    for j in range(WINDOW - BLOCK + 1):  # the rightmost place of a block counts
        np.minimum.at(shift, _slot(_halves(strings[:, j])[0], _halves(strings[:, j + 1])[1]), WINDOW - BLOCK - j)
    suffix = _hash(strings[:, -SUFFIX:], size)
    order = np.argsort(suffix, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    owner = place[back.ravel()]
    posts = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[posts], np.arange(len(strings) + 1))
    return Patterns(ids, size, shift, suffix[order], strings[order], first, np.concatenate(item)[posts], np.concatenate(offset)[posts], [ids[x] for x in parts], keys)


def scan(p: Patterns, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position, string)`` of every test string in the letter ids; ``starts``: bounds of the texts."""
    # segments overlap by a window less one, so no occurrence is cut
    lo = np.concatenate([np.arange(a, max(b - WINDOW + 1, a), SEGMENT) for a, b in zip(starts[:-1], starts[1:])]).astype(np.int64) if len(starts) > 1 else np.empty(0, np.int64)
    if not len(lo):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bound = starts[np.searchsorted(starts, lo, side="right")]
    end = np.minimum(lo + SEGMENT + WINDOW - 1, bound)
    at = lo + WINDOW - 1  # the window's last letter
    begins, ends = _halves(text)
    # the slot of the block that ends at each letter
    slots = np.concatenate([np.zeros(1, np.uint32), _slot(begins[:-1], ends[1:])])
    found = []
    while len(at):
        step = p.shift[slots[at]]
        stop = step == 0
        if stop.any():
            found.append(at[stop])
        at = at + np.maximum(step, 1)
        live = at < end
        at, end = at[live], end[live]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spot = np.concatenate(found)
    suffix = _hash(np.stack([text[spot - SUFFIX + 1 + j] for j in range(SUFFIX)], axis=1).astype(np.int64), p.size)
    left, right = np.searchsorted(p.suffixes, suffix), np.searchsorted(p.suffixes, suffix, side="right")
    many = right - left
    spot = np.repeat(spot, many)
    string = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(many.sum())
    same = np.ones(len(spot), dtype=bool)
    for j in range(WINDOW - SUFFIX):
        same &= text[spot - WINDOW + 1 + j] == p.strings[string, j]
    return spot[same] - WINDOW + 1, string[same]


def align(texts: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Scores of the best local alignments of each text with its passage, all pairs in step.

    A match counts 1, a misread, missing or added letter ``ERROR``: errors by
    themselves cost little, another name in the same phrase costs its length.
    """
    count = len(texts)
    long, wide = max(map(len, texts)), max(map(len, passages))
    a = np.full((count, long), -1, dtype=np.int32)
    b = np.full((count, wide), -2, dtype=np.int32)
    for k, (x, y) in enumerate(zip(texts, passages)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    a[a == 0] = -1  # letters of no passage match none
    score = np.zeros((count, wide + 1), dtype=np.int32)
    best = np.zeros(count, dtype=np.int32)
    steps = (np.arange(wide + 1) * ERROR).astype(np.int32)
    for t in range(long):
        new = np.maximum(score - ERROR, 0)
        np.maximum(new[:, 1:], score[:, :-1] + np.where(b == a[:, t : t + 1], 1, -ERROR), out=new[:, 1:])
        # gaps along the passage: a running maximum of score + ERROR * place
        score = np.maximum.accumulate(new + steps, axis=1) - steps
        np.maximum(best, score.max(axis=1), out=best)
    return best


def leaks(p: Patterns, text: np.ndarray, starts: np.ndarray, codes: np.ndarray, least: int, latin: int) -> Iterator[tuple[int, int, int]]:
    """``(text, passage, score)`` of each pair with an aligned stretch of ``least`` letters (``latin`` for Latin letters)."""
    spot, string = scan(p, text, starts)
    if not len(spot):
        return
    many = p.first[string + 1] - p.first[string]
    post = np.repeat(p.first[string] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    spot = np.repeat(spot, many)
    item, diagonal = p.item[post], spot - p.offset[post]
    row = np.searchsorted(starts, spot, side="right") - 1
    # letters covered on diagonals that drift by a few places: bands of 8, each counted with its neighbour
    band = (diagonal - starts[row]) // 8
    row, item, band, spot = (np.concatenate([x, y]) for x, y in ((row, row), (item, item), (band, band + 1), (spot, spot)))
    order = np.lexsort((spot, band, item, row))
    row, item, band, spot = row[order], item[order], band[order], spot[order]
    gap = np.diff(spot, prepend=0)
    # a far hit on the same diagonal is another place
    cut = (np.diff(row, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0) | (np.diff(band, prepend=band[0] - 1) != 0) | (gap > 60)
    heads = np.flatnonzero(cut)
    got = np.add.reduceat(np.where(cut, WINDOW, np.minimum(gap, WINDOW)), heads)
    lo, hi = spot[heads], spot[np.append(heads[1:], len(spot)) - 1] + WINDOW
    # the script by most of the stretch's letters; digits are of neither
    roman = np.concatenate([[0], np.cumsum((codes < 0x250) & ~((codes >= 0x30) & (codes <= 0x39)))])
    wide = np.concatenate([[0], np.cumsum(codes >= 0x250)])
    wide = wide[hi] - wide[lo]
    plain = (roman[hi] - roman[lo] > wide) | (wide == 0)
    keep = np.flatnonzero(got >= np.where(plain, latin, least) * SEED_SHARE)
    # neighbouring bands tell of one place: of the runs within it, only what the fullest one covers is aligned once
    keep = keep[np.argsort(-got[keep], kind="stable")]
    place = np.stack([row[heads[keep]], item[heads[keep]], lo[keep], hi[keep]])
    _, best = np.unique(place, axis=1, return_index=True)
    keep = keep[np.sort(best)]
    keep = keep[_uncovered(row[heads[keep]], item[heads[keep]], lo[keep], hi[keep], band[heads[keep]])]
    pairs: dict[tuple[int, int], int] = {}
    # the text around the run against the stretch of the passage that its diagonal leads to
    r, i = row[heads[keep]], item[heads[keep]]
    t0, t1 = np.maximum(starts[r], lo[keep] - REACH), np.minimum(starts[r + 1], hi[keep] + REACH)
    on = band[heads[keep]] * 8 + starts[r]
    p0 = np.maximum(t0 - on - REACH, 0)
    p1 = np.minimum(t1 - on + REACH, np.array([len(p.letters[k]) for k in i], dtype=np.int64))
    order = np.argsort((t1 - t0) * (p1 - p0), kind="stable")
    at = 0
    while at < len(order):
        step = max(1, ALIGN_CELLS // int(max((p1 - p0)[order[at]], 1) * 2))
        part = order[at : at + min(step, 512)]
        part = part[: np.searchsorted(np.maximum.accumulate((p1 - p0)[part]), 2 * max((p1 - p0)[part[0]], 32), side="right")]
        at += len(part)
        score = align([text[a:z] for a, z in zip(t0[part], t1[part])], [p.letters[k][a:z] for k, a, z in zip(i[part], p0[part], p1[part])])
        for x, k, s, l in zip(r[part].tolist(), i[part].tolist(), score.tolist(), plain[keep[part]].tolist()):
            if s >= (latin if l else least):
                pairs[x, k] = max(s, pairs.get((x, k), 0))
    for (x, k), s in pairs.items():
        yield x, k, s


def _uncovered(row: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Places (fullest first) that no fuller one of the same text and passage, of the same or a neighbouring band, covers with its reach."""
    taken: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    out = []
    for k, (r, i, a, z, d) in enumerate(zip(row.tolist(), item.tolist(), lo.tolist(), hi.tolist(), band.tolist())):
        mine = taken.setdefault((r, i), [])
        if not any(x - REACH // 2 <= a and z <= y + REACH // 2 and abs(d - e) <= 2 for x, y, e in mine):
            mine.append((a, z, d))
            out.append(k)
    return np.array(out, dtype=np.int64)


def leaked_passages(docs: DataFrame, items: DataFrame, *, key: str, text: str, item: str, passage: str, least: int = 36, latin: int = 52) -> DataFrame:
    """``(key, item, score)``: each document with each passage it gives away a stretch of.

    ``score``: letters (no blanks, signs or marks) of one local alignment less
    three for each error; about 40 letters with their share of errors reach
    ``least``. Latin letters say less each, so their phrases need ``latin``. Null
    keys, texts and passages are no case, repeated rows give one row, empty tables
    none. The passages are a bounded list; those beyond ``BLOCK_LETTERS`` letters
    are searched in further blocks, each against all documents.
    """
    spark = docs.sparkSession
    listed = items.where(F.col(item).isNotNull() & F.col(passage).isNotNull()).select(F.col(item).alias("item"), F.col(passage).alias("passage"))
    total = listed.agg(F.sum(F.length("passage"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_LETTERS))
    kind, name = docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"key {kind}, item {name}, score int"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    out = spark.createDataFrame([], schema)
    for n in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).distinct().toPandas()
        compiled = compile_patterns(part["item"].tolist(), part["passage"].tolist()) if len(part) else None
        if compiled is None:
            continue
        shared = spark.sparkContext.broadcast(compiled)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            p = shared.value
            for pdf in batches:
                # slices of texts, each of some PASS_CHARS characters, keep the arrays of hits small
                cuts = np.flatnonzero(np.diff(pdf["text"].str.len().cumsum().to_numpy() // PASS_CHARS, prepend=0))
                for lo, hi in zip([0, *cuts], [*cuts, len(pdf)]):
                    part = pdf.iloc[lo:hi]
                    codes, starts = letters_of(part["text"].tolist())
                    found = list(leaks(p, p.ids[np.minimum(codes, 0x2FFFF)], starts, codes, least, latin))
                    yield pd.DataFrame([(part["key"].iloc[r], p.keys[i], s) for r, i, s in found], columns=["key", "item", "score"])

        out = out.union(rows.mapInPandas(run, schema))
    return out.groupBy("key", "item").agg(F.max("score").alias("score"))
