"""Distances of many pairs of short texts at once, on code-point arrays.

Pairs are sorted by length and taken in slices, so an array is never much wider
than its texts; in a slice all pairs go through the recurrence in step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

#: cells of one array of a slice
CELLS = 400_000


def codes(texts: Sequence[str]) -> np.ndarray:
    """``(texts, longest)`` code points, zero beyond the end of a text; a text's own NULs count as the last code point."""
    made = np.array([t.replace("\0", "\U0010ffff") for t in texts], dtype=np.str_)
    wide = made.dtype.itemsize // 4
    return made.view(np.uint32).reshape(len(made), wide).astype(np.int32) if wide else np.zeros((len(made), 0), dtype=np.int32)


def in_slices(a: Sequence[str], b: Sequence[str], run: Callable, *more: np.ndarray, cells: int | None = None) -> tuple[np.ndarray, ...]:
    """``run(a, b, length of a, length of b, *more)`` over slices of alike lengths; its arrays in the order of the pairs."""
    a, b = list(a), list(b)
    n, m = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a, b))
    order = np.argsort(np.maximum(n, m), kind="stable")
    out: list[np.ndarray] = []
    at = 0
    while at < len(order):
        step = max(1, (cells or CELLS) // (int(max(n[order[at]], m[order[at]])) * 2 + 8))
        part = order[at : at + step]
        # a slice ends where the texts get twice as long as its first ones
        part = part[: np.searchsorted(np.maximum(n, m)[part], 2 * max(n[part[0]], m[part[0]]) + 8, side="right")]
        got = run(codes([a[k] for k in part]), codes([b[k] for k in part]), n[part], m[part], *[x[part] for x in more])
        got = got if isinstance(got, tuple) else (got,)
        if not out:
            out = [np.zeros(len(order), dtype=g.dtype) for g in got]
        for o, g in zip(out, got):
            o[part] = g
        at += len(part)
    return tuple(out) if out else (np.zeros(0),)


def edits(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Edit distances with swaps of neighbours."""

    def run(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        place = np.arange(y.shape[1] + 1, dtype=np.int32)
        before, row = None, np.broadcast_to(place, (len(x), len(place))).copy()
        out = np.where(n == 0, m, 0).astype(np.int32)
        at = np.arange(len(x))
        for i in range(1, x.shape[1] + 1):
            same = y == x[:, i - 1 : i]
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + ~same, out=new[:, 1:])
            if before is not None and y.shape[1] > 1:
                swapped = same[:, :-1] & (y[:, 1:] == x[:, i - 2 : i - 1])
                np.minimum(new[:, 2:], np.where(swapped, before[:, :-2] + 1, new[:, 2:]), out=new[:, 2:])
            new[:, 0] = i
            # letters added: a running minimum of distance less place
            new = np.minimum.accumulate(new - place, axis=1) + place
            before, row = row, new
            done = n == i
            out[done] = row[at[done], m[done]]
        return out

    return in_slices(a, b, run)[0]


def likeness(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Share of the longer text's letters that an edit distance with swaps leaves; two empty texts are alike."""
    n = np.maximum(np.fromiter(map(len, a), dtype=np.int64, count=len(a)), np.fromiter(map(len, b), dtype=np.int64, count=len(b)))
    return 1 - edits(a, b) / np.maximum(n, 1)


def jaro_winkler(a: Sequence[str], b: Sequence[str], weight: float = 0.1) -> np.ndarray:
    """Jaro-Winkler similarities; equal texts are 1, an empty one and another 0."""

    def run(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        count, wide = len(x), y.shape[1]
        reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)[:, None]
        place = np.arange(wide)[None, :]
        used = np.zeros((count, wide), dtype=bool)
        mine = np.zeros(x.shape, dtype=bool)
        rows = np.arange(count)
        for i in range(x.shape[1]):
            if not wide:
                break
            free = (y == x[:, i : i + 1]) & ~used & (place >= i - reach) & (place <= i + reach) & (x[:, i : i + 1] != 0)
            first = free.argmax(axis=1)
            hit = free[rows, first]
            used[rows[hit], first[hit]] = True
            mine[:, i] = hit
        hits = mine.sum(axis=1)
        # matched letters of both in order, side by side
        most = int(hits.max()) if count else 0
        left, right = np.zeros((count, most), dtype=np.int32), np.zeros((count, most), dtype=np.int32)
        for out, flags, text in ((left, mine, x), (right, used, y)):
            r, c = np.nonzero(flags)
            out[r, (np.cumsum(flags, axis=1) - 1)[r, c]] = text[r, c]
        half = (left != right).sum(axis=1) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(hits > 0, (hits / n + hits / m + (hits - half) / hits) / 3, 0.0)
        k = min(4, x.shape[1], wide)
        prefix = np.cumprod((x[:, :k] == y[:, :k]) & (x[:, :k] != 0), axis=1).sum(axis=1) if k else 0
        out = jaro + weight * prefix * (1 - jaro)
        equal = (n == m) & (hits == n) & (half == 0) if wide == x.shape[1] else (n == m) & (n == 0)
        if wide == x.shape[1]:
            equal = (x == y).all(axis=1)
        return np.where(equal, 1.0, out)

    return in_slices(a, b, run)[0]


def only_added(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """True where the shorter text is what a few missing letters leave of the longer one."""

    def run(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        swap = n > m
        wide = max(x.shape[1], y.shape[1])
        x, y = (np.pad(z, ((0, 0), (0, wide - z.shape[1]))) for z in (x, y))
        short, long = np.where(swap[:, None], y, x), np.where(swap[:, None], x, y)
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for j in range(wide):
            step = (at < wide) & (long[:, j] != 0)
            step &= short[rows, np.minimum(at, wide - 1)] == long[:, j]
            at += step
        return at >= np.minimum(n, m)

    return in_slices(a, b, run)[0].astype(bool)
