"""Hard negatives against all pairs."""

import math
import random

import brute
import numpy as np
import pytest

from dqtable.llm import hard_negatives as module
from dqtable.llm.hard_negatives import hard_negatives, summaries


def expected(rows):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every window."""
    part = []
    for vec_id, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        part.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vec], label))
    out = []
    for i, (anchor, own, label) in enumerate(part):
        if anchor is None or anchor % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(own, v, strict=False)), d is None, d or 0, d, other)
            for j, (d, v, other) in enumerate(part)
            if j != i
        ]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[4] == label][:5]:
            high = [s for s in scored if s[4] != label and -30 * p[0] <= -100 * s[0] <= -90 * p[0]]
            out += [(anchor, p[3], k + 1, s[3], -p[0], -s[0]) for k, s in enumerate(high[:10])]
    return brute.Counter(out)


def clustered(rng, count, dims, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(count):
        centre = rng.choice(centres)
        vec = [c + rng.gauss(0, spread) for c in centre]
        norm = math.sqrt(sum(x * x for x in vec))
        rows.append((i, [float(np.float32(x / norm)) for x in vec], rng.randrange(10)))
    return rows


ODD = [
    (None, [0.5] * 9, 3), (100, None, 1), (200, [0.1, None] + [0.0] * 7, 1), (300, [float("nan")] * 9, 1),
    (301, [float("inf")] * 9, 2), (302, [0.25] * 9, None), (400, [0.5, -0.5], 3), (500, [], 3), (500, [], 3),
    (600, [1.0] * 9, 4), (600, [1.0] * 9, 4), (7, [1.0] * 9, 3), (None, [0.5] * 9, 3), (-100, [-0.25] * 9, 9),
]


@pytest.mark.parametrize("block, cells, held", [(4096, 1 << 21, 1 << 18), (2, 50, 20)])
@pytest.mark.parametrize("dims, spread", [(9, 0.3), (33, 2.0)])
def test_all_pairs(spark, monkeypatch, block, cells, held, dims, spread):
    """Also with small blocks of anchors, rows and candidates."""
    monkeypatch.setattr(module, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(module, "CELLS", cells)
    monkeypatch.setattr(module, "HELD", held)
    rows = clustered(random.Random(dims), 700, dims, spread) + ODD
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.repartition(5).selectExpr("*", "1 as uid", "'x' as vec", "2 as anchor", "3 as score")
    got = brute.Counter(tuple(r) for r in hard_negatives(df).collect())
    assert got == expected(rows) and len(got) > 100
    assert hard_negatives(df.where("false")).isEmpty()
    assert hard_negatives(df.where("vec_id = 1")).isEmpty()


def test_large_components(spark):
    """Products beyond 53 bits."""
    rows = [(k, [2.0**19 - k * 2.0**-8, 2.0**18 + k, -(2.0**17)], k % 2) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    found = hard_negatives(df, low_percent=-100, high_percent=100, relabel_every=1 << 40)
    for r in found.collect():
        own, other = ([math.floor(256 * x) for x in rows[k][1]] for k in (r.anchor_id, r.negative_id))
        assert r.negative_score == sum(a * b for a, b in zip(own, other, strict=True))


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = (np.floor(256 * rng.normal(0, 0.2, (40, 37))) for _ in range(2))
    a, b, exact = summaries(x), summaries(y), x @ y.T
    widths = []
    for means, spreads in module._levels(37):
        middle, width = a[:, means] @ b[:, means].T, a[:, spreads] @ b[:, spreads].T
        assert (np.abs(exact - middle) <= width + 1e-6).all()
        widths.append(width.mean())
    assert widths == sorted(widths, reverse=True)
