import random

import numpy as np
import pytest

from folioforge.llm import distances as D


def brute_edits(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def brute_jaro_winkler(a, b):
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = set(), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if j not in used and b[j] == c), None)
        if j is not None:
            used.add(j)
            hits.append(c)
    if not hits:
        return 0.0
    half = sum(x != b[j] for x, j in zip(hits, sorted(used))) / 2
    m = len(hits)
    jaro = (m / len(a) + m / len(b) + (m - half) / m) / 3
    prefix = next((k for k in range(4) if a[k : k + 1] != b[k : k + 1] or k >= min(len(a), len(b))), 4)
    return jaro + 0.1 * prefix * (1 - jaro)


def pairs(n=4000):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abc漢", k=rng.choice([0, 1, 2, 3, 5, 8, 13, 60])))
    out = [(word(), word()) for _ in range(n)]
    for w in [word() for _ in range(n // 4)]:  # near ones
        k = rng.randrange(len(w) + 1)
        out.append((w, w[:k] + rng.choice("abcx") + w[k + rng.randrange(2) :]))
    return out + [("", ""), ("a\0b", "a\0b"), ("a\0", "a"), ("martha", "marhta"), ("dixon", "dicksonx")]


def test_against_the_recurrences():
    a, b = zip(*pairs())
    assert D.edits(a, b).tolist() == [brute_edits(x, y) for x, y in zip(a, b)]
    assert D.jaro_winkler(a, b).tolist() == pytest.approx([brute_jaro_winkler(x, y) for x, y in zip(a, b)])
    assert D.jaro_winkler(["martha", "dixon"], ["marhta", "dicksonx"]).tolist() == pytest.approx([0.9611, 0.8133], abs=1e-4)

    def inside(x, y):
        x, y = sorted((x, y), key=len)
        rest = iter(y)
        return all(c in rest for c in x)

    assert D.only_added(a, b).tolist() == [inside(x, y) or inside(y, x) for x, y in zip(a, b)]


def test_slices_and_nothing():
    a, b = zip(*pairs(300))
    cells = D.CELLS
    try:
        D.CELLS = 50  # many slices give the same
        some = D.edits(a, b)
    finally:
        D.CELLS = cells
    assert (some == D.edits(a, b)).all()
    assert len(D.edits([], [])) == len(D.jaro_winkler([], [])) == 0
    assert D.likeness(["abcd"], ["abcx"]).tolist() == [0.75] and D.likeness([""], [""]).tolist() == [1.0]
    assert np.isclose(D.jaro_winkler(["長" * 5000], ["長" * 4999])[0], 1, atol=1e-3)
