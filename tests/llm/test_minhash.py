"""MinHash near-duplicates against all pairs of shingle sets."""

import random

import brute
import numpy as np
import pytest

from dqtable.llm import minhash_dedup
from dqtable.llm.minhash_dedup import (
    MINIMA,
    least_agreement,
    minhash_components,
    shingle_sets,
    signature,
)


def shingles(text, size=3):
    found = brute.words((text or "").translate(brute.LOWER))
    parts = [tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    return frozenset(parts) if found else frozenset()


def expected(rows, percent=85):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and group[i] != group[j] and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        least[g] = min((d for d in (doc, least.get(g)) if d is not None), default=None)
    out = []
    for (doc, _), s, g in zip(rows, sets, group, strict=True):
        out.append((doc, len(s), least[g], doc == least[g]))
    return brute.Counter(out)


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, "two one"), (8, "one one one"),
    (9, "one one one one"), (None, "one two"), (None, "alone"), (None, "alone"), (None, None), (10, "é x y z " * 9000),
    (11, "é x y z " * 9000 + "end"), (12, "a b c"), (13, "a b c"), (13, "a b c"), (13, "other text here"),
]


def copies(rng, n_base, n_rows, words, edits):
    base = [[f"w{rng.randrange(900)}" for _ in range(words)] for _ in range(n_base)]
    rows = []
    for i in range(n_rows):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
        rows.append((1000 + i * 3 % n_rows, " ".join(text)))
    return rows


@pytest.mark.parametrize("small, block, worthwhile", [(16, 1024, 50), (3, 7, 50), (2, 16, 1)])
def test_components(spark, monkeypatch, small, block, worthwhile):
    """Near copies about the threshold, so that many pairs are just no links; also with small
    blocks, and with blocks right after the first stars."""
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash_dedup, "WORTHWHILE", worthwhile)
    rng = random.Random(3)
    rows = ODD + copies(rng, 4, 160, 90, 4) + copies(rng, 30, 60, 40, 1)
    # half of each text in common, which is far from a link but fills buckets
    common = " ".join(f"c{k}" for k in range(60))
    rows += [(5000 + i, common + " " + " ".join(f"o{i}x{k}" for k in range(30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as uid", "'x' as n", "2 as key")
    got = brute.Counter(tuple(r) for r in minhash_components(df).collect())
    assert got == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_components(df).isEmpty()
    alone = spark.createDataFrame([(4, "no other row")], "doc_id long, text string")
    assert [tuple(r) for r in minhash_components(alone).collect()] == [(4, 1, 4, True)]


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    words = [f"w{k}" for k in range(600)]
    for share in (50, 300, 550):
        other = words[:share] + [f"x{rng.random()}" for _ in range(600 - share)]
        a, b = shingle_sets([" ".join(words).encode(), " ".join(other).encode()], 3)
        both = len(np.intersect1d(a, b))
        assert both == share - 2
        agree = (signature(a) == signature(b)).mean()
        assert abs(agree - both / (1196 - both)) < 0.12
    assert 100 < least_agreement(85) < 0.85 * MINIMA
    assert least_agreement(100) == MINIMA
