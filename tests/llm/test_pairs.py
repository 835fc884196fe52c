"""SimHash, the trie join, and connected components, against all pairs."""

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dqtable.llm.components import components
from dqtable.llm.simhash_dedup import drop_near_duplicates, join_tries, simhash_components


def groups(values, pairs):
    own = {v: {v} for v in values}
    for a, b in pairs:
        both = own[a] | own[b]
        for v in both:
            own[v] = both
    return {frozenset(g) for g in own.values()}


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12, unique=True),
    st.lists(st.tuples(st.integers(0, 11), st.sets(st.integers(0, 63), max_size=5)), max_size=30),
    st.integers(0, 4),
)
def test_trie_join_finds_all_links(seeds, changes, budget):
    values = set(seeds)
    for at, bits in changes:
        values.add(seeds[at % len(seeds)] ^ sum(1 << b for b in bits))
    own = np.sort(np.array(sorted(values), np.uint64))
    near = [(a, b) for a in values for b in values if (a ^ b).bit_count() <= budget]
    a, b = join_tries(own, None, 0, budget)
    assert groups(values, zip(a.tolist(), b.tolist(), strict=True)) == groups(values, near)
    top = 62
    left = own[own >> np.uint64(top) == 0]
    right = own[own >> np.uint64(top) == 1]
    if len(left) and len(right) and budget:
        a, b = join_tries(left, right, 2, budget - 1)
        found = groups([*left.tolist(), *right.tolist()], zip(a.tolist(), b.tolist(), strict=True))
        cross = [
            (x, y) for x in left.tolist() for y in right.tolist() if (x ^ y).bit_count() <= budget
        ]
        assert found == groups([*left.tolist(), *right.tolist()], cross)


def test_components(spark, scratch):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(tuple(r) for r in components(df, f"{scratch}/c").collect())
    real = [e for e in edges if e[0] is not None]
    for group in groups({x for e in real for x in e}, real):
        assert all(got.get(v, v) == min(group) for v in group)
    assert components(df.where("false"), f"{scratch}/d").isEmpty()


ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, "é x y z " * 3000),
    (8, "é x y z " * 3000), (8, "é x y z " * 3000), (None, "one"), (None, "alone among rows"),
    (None, "alone among rows"), (9, "a\x85b c\x0bd e"),
]


def near_rows():
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(80)) for _ in range(12)]
    rows = list(ROWS)
    for i in range(100, 220):
        text = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = "changed"
        rows.append((rng.choice([i, i, 150]), " ".join(text)))
    return rows


def test_components_of_documents(spark):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as fp", "1 as root")
    got = brute.Counter(tuple(r) for r in simhash_components(df).collect())
    assert got == brute.near_duplicates(rows)
    assert simhash_components(df.where("false")).isEmpty()


@pytest.mark.parametrize("extra", ["fp", "fingerprint", "component_id", "doc"])
def test_one_of_each_group_stays(spark, extra):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", f"'x' as {extra}")
    if extra != "fp":
        df = df.limit(len(ROWS) + 20)
        rows = [(r.doc_id, r.text) for r in df.collect()]
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    least = {}
    for (doc, _), group in zip(rows, brute.near_groups(rows)[1], strict=True):
        ids = [d for d in (doc, least.get(group)) if d is not None]
        least[group] = min(ids, default=None)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, got)) == sorted(map(str, least.values()))
