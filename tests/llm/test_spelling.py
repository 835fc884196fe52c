"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import brute
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from dqtable.llm import spelling
from dqtable.llm.common import read_table
from dqtable.llm.queries import LLM_QUERIES


def edits(word, letters):
    """Every text one inserted, deleted or replaced letter away."""
    for i in range(len(word) + 1):
        yield word[:i] + word[i + 1 :]
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1 :]


def variants(rows):
    """A plain reading of the contract: (word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    letters = sorted(set("".join(n)))
    near = {w: {e for e in edits(w, letters) if e in n and e != w} for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return Counter(out)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_DIR, "documents").collect()]
    expected = variants(rows)
    assert any(form for _, form, *_ in expected)
    got = LLM_QUERIES["op11_spelling_variants"](spark, SF_DIR).collect()
    assert Counter(tuple(r) for r in got) == expected


def dense_rows():
    """Words of few letters, so that most have many near ones, in chains of growing counts."""
    rng = random.Random(6)
    words = {"".join(rng.choices("abé", k=rng.choice([6, 6, 7, 8, 13]))) for _ in range(500)}
    rows = [(i, " ".join([w.upper() if i % 3 else w] * rng.choice([1, 5, 6, 30, 200]))) for i, w in enumerate(words)]
    rows += [(None, None), (None, ""), (None, "abcdef"), (3, "abcdef×abcdef÷abcdefÿ"), (3, "abcdef " * 4), (4, "z" * 400)]
    rows += [(9, ("z" * 401 + " ") * 25)] + [(4, "z" * 400)] * 4 + [(7, "common" + c + "tail") for c in "abcdefgh" * 5]
    return rows


@pytest.mark.parametrize("share", [2000, 3])
def test_dense_words(spark, monkeypatch, share):
    """Also with dictionaries that hold most grams or next to none, and small tasks."""
    monkeypatch.setattr(spelling, "SHARE", share)
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (share,))
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    rows = dense_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n", "2 as id")
    assert Counter(tuple(r) for r in spelling.spelling_variants(df).collect()) == variants(rows)
    assert spelling.spelling_variants(df.where("false")).isEmpty()


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=6, max_size=14), st.data())
def test_near_words_share_a_gram_beyond_the_bound(word, data):
    """However the dictionary looks, more grams are shared than the bound allows to be lost."""
    grams = sorted({word[p : p + q] for q in range(2, 6) for p in range(len(word))})
    dictionary = frozenset(data.draw(st.sets(st.sampled_from(grams))))
    for other in set(edits(word, "abc")) - {word}:
        if len(other) < len(word):
            continue
        longest = min(spelling.LONGEST, len(word) // 2)
        own, affected = spelling.grams_of(word, longest, dictionary)
        far, _ = spelling.grams_of(other, longest, dictionary)
        places = set(far) | ({(p - 1, g) for p, g in far} if len(other) > len(word) else set())
        assert len(own) > affected
        assert sum(g in places for g in own) >= len(own) - affected
