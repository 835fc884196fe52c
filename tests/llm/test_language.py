"""The recurrent model: gradients, probabilities, state across windows, held-out scores."""

import random
import time
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from dqtable.llm import lm_scoring
from dqtable.llm.lm_scoring import Network, first_weights, language_scores, packed, run_lanes, unpacked


@pytest.fixture
def small(monkeypatch):
    """Six words in three classes, so that all texts of a length can be listed."""
    for name, value in {"CLASSES": 3, "CLASS_SIZE": 2, "WIDTH": 4, "VOCABULARY": 6, "STEPS": 3}.items():
        monkeypatch.setattr(lm_scoring, name, value)
    shapes = {
        "table": (6, 4), "input": (4, 12), "bias": (12,), "state": (4, 12), "class": (4, 3),
        "class_bias": (3,), "word": (3, 4, 2), "word_bias": (3, 2),
    }
    monkeypatch.setattr(lm_scoring, "_SHAPES", shapes)
    weights = {k: v.astype(np.float64) for k, v in first_weights(6).items()}
    rng = np.random.default_rng(0)
    return {k: v + rng.normal(size=v.shape) for k, v in weights.items()}


def test_gradients(small):
    rng = np.random.default_rng(1)
    ids, target = rng.integers(0, 6, (5, 3)), rng.integers(0, 6, (5, 3))
    start = np.zeros((5, 3), bool)
    start[0] = start[2, 1] = True
    mask = rng.random((5, 3)) < 0.8
    state = np.zeros((3, 4))

    def loss(weights):
        return -Network(weights).window(ids, start, target, mask, state, False)[0][mask].sum()

    grad = Network(small).window(ids, start, target, mask, state, True)[2]
    for name, value in small.items():
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(4)]:
            step = {k: v.copy() for k, v in small.items()}
            step[name][at] += 1e-3
            up = loss(step)
            step[name][at] -= 2e-3
            assert (up - loss(step)) / 2e-3 == pytest.approx(grad[name][at], abs=2e-2, rel=2e-2)


def test_probabilities_add_up(small):
    """Over all texts of two tokens, in one run of lanes and across windows."""
    docs = [np.array([a, b], np.int32) for a in range(6) for b in range(6)]
    assert np.exp(run_lanes(Network(small), docs)).sum() == pytest.approx(1, abs=1e-5)
    long = np.array([1, 2, 3, 4, 5, 0, 1, 2], np.int32)
    alone = run_lanes(Network(small), [long])[0]
    assert run_lanes(Network(small), [*docs, long, *docs])[36] == pytest.approx(alone, rel=1e-5)
    tails = [np.array([*long, x], np.int32) for x in range(6)]
    assert np.exp(run_lanes(Network(small), tails) - alone).sum() == pytest.approx(1, abs=1e-4)


def test_weights_survive_packing():
    weights = first_weights(50)
    for name, value in unpacked(packed(weights)).items():
        assert np.array_equal(value, weights[name])


ROWS = [(1, None), (2, ""), (3, "A a\x85 b"), (None, "a B c"), (4, "rare " * 4000), (5, "é 世 é")]


def test_base_scores(spark):
    rows = [*ROWS, *((i, f"w{i % 7} a b w{i}") for i in range(10, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as uid", "2 as tail")
    _, total, expected = brute.unigram(rows)
    got = language_scores(df).collect()
    assert len(got) == len(rows)
    for r in got:
        held, tokens, known, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
        assert r.base_score == pytest.approx(score, abs=1e-9, rel=1e-12)
        assert r.score < 0
    assert language_scores(df.where("false")).isEmpty()
    alone = language_scores(df.where("doc_id = 2")).first()
    assert (alone.n_tokens, alone.train_tokens) == (1, 1 - alone.held_out)


def test_rare_words_are_joined(spark, monkeypatch):
    """With two words in the broadcast, the join gives the same base scores."""
    rows = [(i, f"w{i % 7} a b w{i} a") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lm_scoring, "KNOWN", 2)
    for r in language_scores(df).collect():
        assert r.base_score == pytest.approx(brute.unigram(rows)[2][r.doc_id][3], rel=1e-9)


def test_the_model_learns_what_counts_cannot(spark):
    """Words in a fixed cycle: the next one is certain, though all are equally frequent."""
    rng = random.Random(2)
    cycle = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(900):
        at = rng.randrange(30)
        rows.append((i, " ".join(cycle[(at + k) % 30] for k in range(60))))
    got = language_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    held = [r for r in got if r.held_out]
    per_token = sum(r.score for r in held) / sum(r.n_tokens for r in held)
    base = sum(r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert per_token > base + 0.4


def test_words_of_the_magnitude_that_crosses_the_bound(spark, monkeypatch):
    """They are taken by count, and those of one count in part."""
    monkeypatch.setattr(lm_scoring, "KNOWN", 40)
    some = [(b"", 9)] + [(b"a%d" % i, 1000 + i % 2) for i in range(50)]
    known = lm_scoring._frequent(spark.createDataFrame(some, "word binary, c long"))
    assert 38 <= len(known) <= 40 and b"" not in known
    assert [c for c in known.values()][:25] == [1001] * 25 and set(list(known.values())[25:]) == {1000}
    few = spark.createDataFrame(some[:30], "word binary, c long")
    assert lm_scoring._frequent(few) == dict(some[1:30])


def test_weights_merge_in_levels(spark, monkeypatch):
    """Whatever the fan-in, the same weights but for rounding; long words are joined."""
    rows = [(i, f"w{i % 7} a b {'long' * 30}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    want = {r.doc_id: r for r in language_scores(df).collect()}
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)
    for r in language_scores(df).collect():
        assert r.score == pytest.approx(want[r.doc_id].score, rel=1e-5)
        assert r.base_score == pytest.approx(brute.unigram(rows)[2][r.doc_id][3], rel=1e-9)


def _one_by_one(texts, index, logs):
    """What lm_scoring._looked_up gives, in plain Python."""
    lists = [t.lower().split() for t in texts]
    at = [[index.get(w, -1) for w in words] for words in lists]
    ids = [[*(k + 2 if 0 <= k < lm_scoring.VOCABULARY - 2 else 1 for k in own), 0] for own in at]
    log = [sum(logs[k] for k in own if k >= 0) for own in at]
    tails = [Counter(w for w, k in zip(words, own, strict=True) if k < 0) for words, own in zip(lists, at, strict=True)]
    return ids, log, tails


def _tails(tails):
    lengths, words, times = tails
    pairs, at = list(zip(words.to_pylist(), times.tolist(), strict=True)), 0
    for n in lengths.tolist():
        yield dict(pairs[at : at + n])
        assert len(dict(pairs[at : at + n])) == n
        at += n


def test_words_are_split_at_six_blanks_and_need_not_be_utf8():
    texts = [b"", b" \t", b"  A b ", b"x".join(bytes([i]) for i in range(256)), b"\xff\xc3 \x85Q\x1c \x0b\x0c z"]
    words, size = lm_scoring.words_of(texts)
    assert words.to_pylist() == [w for t in texts for w in t.lower().split()]
    assert size.tolist() == [len(t.split()) for t in texts]
    words, size = lm_scoring.words_of(texts[:2])
    assert (len(words), size.tolist()) == (0, [0, 0])


def test_words_are_looked_up_together():
    """As one by one, and in clearly less CPU time."""
    rng = np.random.default_rng(5)
    draws = (rng.pareto(0.6, (300, 1500)) * 10).astype(np.int64) % 1_000_000
    texts = [b"", b" ", *(" ".join(f"Word{x}" for x in row).encode() for row in draws.tolist())]
    count = Counter(w for t in texts for w in t.lower().split())
    known = [w for w, _ in count.most_common(3000)]
    index, logs = {w: i for i, w in enumerate(known)}, np.log10(np.array([*(count[w] for w in known), 0]) + 1.0)
    table = pa.array(known, pa.binary())
    took = {}
    for _ in range(3):
        for name, find in (
            ("plain", lambda: _one_by_one(texts, index, logs)),
            ("arrow", lambda: lm_scoring._looked_up(texts, table, logs)),
        ):
            begun = time.process_time()
            got = find()
            took[name] = min(time.process_time() - begun, took.get(name, (9e9, 0))[0]), got
    ids, log, tails = took["plain"][1]
    got_ids, sums, got_tails = took["arrow"][1]
    assert [x.tolist() for x in got_ids] == ids
    assert sums[0].tolist() == [len(x) for x in ids] and sums[1] == pytest.approx(log)
    assert list(_tails(got_tails)) == tails and sum(map(len, tails)) > 1000
    assert took["arrow"][0] < 0.6 * took["plain"][0]


def test_counts_are_handed_on_when_many(spark, monkeypatch):
    rows = [(i, f"w{i % 7} a b w{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(lm_scoring, "HELD", 3)
    held = brute.unigram(rows)[2]
    train = [t for i, t in rows if not held[i][0]]
    expected = Counter(w.encode() for t in train for w in t.split()) + Counter({b"": len(train)})
    assert {bytes(r.word): r.c for r in lm_scoring.count_words(df).collect()} == expected


def test_a_softmax_for_scores_does_not_normalise_its_rows():
    """Only learning needs the gradient."""
    rng = np.random.default_rng(3)
    x, pick = rng.normal(size=(5000, 8)), rng.integers(0, 8, 5000)
    share = np.exp(x) / np.exp(x).sum(1)[:, None]
    alone, learned = x.copy(), x.copy()
    for rows, learn in ((alone, False), (learned, True)):
        found = lm_scoring._softmax(rows, pick, 9.0, learn)
        assert found == pytest.approx(np.log(share[np.arange(5000), pick]))
    assert np.array_equal(alone, np.exp(x))
    share[np.arange(5000), pick] -= 1
    assert np.allclose(learned, share)
