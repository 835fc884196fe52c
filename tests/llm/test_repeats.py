"""Repeated words and bytes against plain scans; the sorter against sorted()."""

import random

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from dqtable.llm import suffix_dedup
from dqtable.llm.common import read_table
from dqtable.llm.substring_dedup import without_repeats
from dqtable.llm.suffix_dedup import BlindTrie, equal_classes, without_repeated_bytes


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab\0", min_size=6, max_size=6).map(str.encode), min_size=1, max_size=30))
def test_blind_trie_sorts(strings):
    trie = BlindTrie(strings[0])
    leaves = [0] + [trie.insert(s) for s in strings[1:]]
    assert [trie.strings[i] for i in trie.ordered()] == sorted(set(strings))
    assert [trie.strings[i] for i in leaves] == strings


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=30, max_size=120), st.integers(9, 25), st.sampled_from([0, 8, 16, 32]))
def test_classes_are_those_of_equal_strings(data, length, shallow):
    data = bytes(b % 3 for b in data)
    starts = np.arange(len(data) - length + 1)
    groups = starts % 2
    label = equal_classes(data, starts, groups, length, shallow)
    keys = [(int(g), data[s : s + length]) for s, g in zip(starts.tolist(), groups.tolist(), strict=True)]
    order = np.argsort(label, kind="stable")
    assert [keys[i] for i in order] == sorted(keys)
    for i in range(len(keys)):
        for j in range(i):
            assert (label[i] == label[j]) == (keys[i] == keys[j])


def near_copies(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choices("ab cd ef gh ij kl é".split(), k=rng.randint(0, 120))) for _ in range(30)]
    rows = []
    for i in range(110):
        kind, text = rng.random(), rng.choice(base)
        if 0.3 <= kind < 0.6 and text:
            parts = text.split()
            parts[rng.randrange(len(parts))] = "zz"
            text = " ".join(parts)
        elif 0.6 <= kind < 0.8:
            text = f"p{i} {' '.join(text.split()[rng.randint(0, 40):])} {rng.choice(base)}"
        elif 0.8 <= kind < 0.85:
            text = "a " * rng.randint(0, 400)
        elif 0.85 <= kind < 0.9:
            text = "x" * rng.randint(0, 700)
        elif kind >= 0.9:
            text = rng.choice(["", None, " \n", f"{text} {text}"])
        rows.append((rng.choice([i, i, i, 3, None]), text))
    return rows


@pytest.mark.parametrize("seed", [5, 6])
def test_near_copies(spark, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).selectExpr("*", "'c' as uid")
    words = without_repeats(df).collect()
    assert brute.Counter(tuple(r)[:4] for r in words) == brute.repeated_words(rows)
    assert all(brute.sha(r.kept_text) == r.kept_sha256 for r in words)
    found = without_repeated_bytes(df).collect()
    assert brute.Counter(tuple(r)[:5] for r in found) == brute.repeated_bytes(rows)
    assert all(brute.sha(bytes(r.kept)) == r.kept_sha256 for r in found)


def test_no_task_sorts_all_texts_around_one_passage(spark, monkeypatch):
    """The edges of a passage make a context per text under one key, and the same result in parts."""
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=170))
    word = lambda: "".join(rng.choices("ijklmnop", k=rng.randint(60, 140)))
    rows = [(rng.choice([i, None]), f"{word()}{passage}{word()}" if i % 3 else word()) for i in range(120)]
    rows += near_copies(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen, inner = [], suffix_dedup.first_windows
    monkeypatch.setattr(suffix_dedup, "_BUSY", 20)
    monkeypatch.setattr(suffix_dedup, "first_windows", lambda *a: seen.append(a) or inner(*a))
    got = without_repeated_bytes(df).collect()
    assert brute.Counter(tuple(r)[:5] for r in got) == brute.repeated_bytes(rows)
    (contexts, spec), = seen
    assert contexts.groupBy("key").count().agg({"count": "max"}).first()[0] > 70
    assert suffix_dedup._dealt(contexts, spec).groupBy("key").count().agg({"count": "max"}).first()[0] <= 20


def test_empty_and_whole_tables(spark):
    docs = read_table(spark, SF_DIR, "documents")
    assert without_repeats(docs.where("false")).isEmpty()
    assert without_repeated_bytes(docs.where("false")).isEmpty()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert brute.Counter(tuple(r)[:4] for r in without_repeats(docs).collect()) == brute.repeated_words(rows)
    got = brute.Counter(tuple(r)[:5] for r in without_repeated_bytes(docs).collect())
    assert got == brute.repeated_bytes(rows)
