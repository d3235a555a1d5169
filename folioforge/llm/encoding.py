"""Encoding of a whole corpus with a public byte-level BPE vocabulary.

Ordinary texts are encoded where they lie, batch by batch, without a shuffle.
Long texts are cut: between pre-tokens where there are any, and long unsplit
text (one pre-token beyond ``leaf_chars``) into halves again and again. The parts
are encoded in parallel by any task and joined as a tree. A join re-encodes a
window around the seam and widens it until the window begins with the token the
left part has there and ends with the token the right part has there. A token
sequence is the encoding of its text exactly if each pair of neighbours is the
encoding of its own text, so agreement on both sides makes the joined sequence
exact, not nearly so.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-token pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@functools.cache
def encoder(path: str):
    """The encoder of a vocabulary file of ``base64-token rank`` lines; one a worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_piece(enc, text: bytes) -> list[int]:
    """Merges over one piece of bytes, without pre-tokens."""
    return enc._core_bpe.encode_single_piece(text) if text else []


def join(enc, left: list[int], right: list[int]) -> list[int]:
    """The encoding of the two parts' text, by windows that grow until both sides agree."""
    if not left or not right:
        return left + right
    width = 1
    while True:
        a, b = left[-width:], right[:width]
        middle = encode_piece(enc, enc.decode_bytes(a + b))
        starts = len(a) == len(left) or middle[0] == a[0]
        ends = len(b) == len(right) or middle[-1] == b[-1]
        # a window of one token a side proves nothing unless it still has both as they were
        if starts and ends:
            return left[: len(left) - len(a)] + middle + right[len(b) :]
        width *= 2


def join_tree(enc, parts: list[list[int]]) -> list[int]:
    """Joins neighbours level by level."""
    while len(parts) > 1:
        parts = [join(enc, *parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def halves(text: str, leaf: int) -> list[str]:
    """Halves, halves of halves and so on, until none is longer than ``leaf``."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


def cut(text: str, leaf: int) -> Iterator[tuple[int, str]]:
    """``(unit, part)``: parts of one unsplit pre-token share a unit; other units are runs of whole pre-tokens."""
    unit, run, size = 0, [], 0
    for match in regex.finditer(PATTERN, text):
        piece = match.group()
        if size + len(piece) > leaf:
            for part in _flush(run):
                yield unit, part
                unit += 1
            run, size = [], 0
        if len(piece) > leaf:
            for part in halves(piece, leaf):
                yield unit, part
            unit += 1
        else:
            run.append(piece)
            size += len(piece)
    for part in _flush(run):
        yield unit, part
        unit += 1


def _flush(run: list[str]) -> list[str]:
    """A run as one part; blanks at its end stay apart, as their split depends on what follows."""
    end = len(run)
    while end and run[end - 1][-1].isspace():
        end -= 1
    return [*(["".join(run[:end])] if end else []), *run[end:]]


def encode_corpus(df: DataFrame, *, key: str, text: str, vocabulary: str = VOCABULARY, leaf_chars: int = 16_384) -> DataFrame:
    """``(key, ids)``: the token ids of each row's text, without special tokens, one row for each input row.

    Null and empty texts have the empty list. Strings of special tokens are
    ordinary text. Keys may repeat or be null; each row keeps its own result. The
    vocabulary file must lie at the same path on every executor; it is read there
    and never shipped. An empty table gives no rows; other columns are ignored.
    """
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            arrays = [np.asarray(enc.encode_ordinary(x), dtype=np.int32) if x else np.empty(0, np.int32) for x in batch.column(1).to_pylist()]
            ends = np.zeros(len(arrays) + 1, dtype=np.int32)
            np.cumsum([len(a) for a in arrays], out=ends[1:])
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["key", "ids"])

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k, whole, x in zip(pdf["row"], pdf["key"], pdf["text"]):
                rows = [(k, whole, n, unit, part) for n, (unit, part) in enumerate(cut(x, leaf_chars))]
                yield pd.DataFrame(rows, columns=["row", "key", "n", "unit", "part"])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary)
        for pdf in batches:
            one = [encode_piece(enc, p.encode()) if split else enc.encode_ordinary(p) for p, split in zip(pdf["part"], pdf["split"])]
            yield pd.DataFrame({"row": pdf["row"], "key": pdf["key"], "n": pdf["n"], "unit": pdf["unit"], "ids": one})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        enc, out = encoder(vocabulary), []
        for _, unit in pdf.sort_values("n").groupby("unit", sort=True):
            out.extend(join_tree(enc, [list(map(int, x)) for x in unit["ids"]]))
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "ids": [out]})

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    brief = rows.where(size <= leaf_chars).mapInArrow(short, schema)
    name = schema.fields[0].dataType.simpleString()
    # a row number of its own keeps rows of equal keys apart; it is the same if a task runs again
    long_rows = rows.where(size > leaf_chars).withColumn("row", F.monotonically_increasing_id())
    cuts = long_rows.mapInPandas(parts, f"row long, key {name}, n int, unit int, part string")
    # parts of one unsplit pre-token are merged as bytes; they are the units longer than a leaf
    marked = cuts.withColumn("split", F.sum(F.length("part")).over(_unit()) > leaf_chars)
    encoded = marked.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "n").mapInPandas(encode, f"row long, key {name}, n int, unit int, ids array<int>")
    return brief.union(encoded.groupBy("row").applyInPandas(whole, schema))


def _unit():
    from pyspark.sql.window import Window

    return Window.partitionBy("row", "unit")
