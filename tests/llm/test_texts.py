"""Quality rules, decontamination, personal data, tokens and counts, against plain readings."""

import random

import brute
import pytest
from conftest import SF_DIR

from dqtable.llm import decontaminate, pii
from dqtable.llm.common import read_table
from dqtable.llm.quality import keep_good, quality_verdicts

EDGES = [None, "", " \n\t ", "x", "a\n a\na\n\na", "é#*|<> $ % é#*|<> $ % é#*|<>", "w " * 70_000]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in read_table(spark, SF_DIR, "documents").collect()]


def test_statistics_and_base_rule(spark, documents):
    rows = [(i, t, "en", "s") for i, t in enumerate(EDGES)] + [(0, None, None, None), (None, "x y", "", "s")]
    rows += [(i + 100, t, "en", f"s{i % 3}") for i, (_, t) in enumerate(documents[:60])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted(tuple(r)[:7] for r in quality_verdicts(df).na.fill(-1, ["doc_id"]).collect())
    expected = []
    for doc, text, *_ in rows:
        s = brute.quality(text)
        expected.append((-1 if doc is None else doc, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert got == sorted(expected)
    assert all(not r.kept for r in quality_verdicts(df).where("base_failed").collect())
    assert quality_verdicts(df.where("false")).isEmpty()


def ordinary(rng):
    lines = []
    for _ in range(rng.randint(6, 14)):
        lines.append(" ".join("".join(rng.choices("abcdefghilmnorst", k=rng.randint(2, 8))) for _ in range(rng.randint(8, 16))))
    return "\n".join(lines)


def test_outliers_go_and_ordinary_documents_stay(spark):
    """A fifth of a source is junk, which would drag a plain mean and covariance along."""
    rng = random.Random(8)
    rows = [(i, ordinary(rng), "en", "a" if i % 2 else "b", i) for i in range(600)]
    for i in range(600, 680):
        junk = " ".join(f"{ordinary(rng)[:5]}#$%|<>&*" for _ in range(90))
        rows.append((i, junk, "en", "a", i))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept long")
    verdict = {r.doc_id: r.kept for r in quality_verdicts(df).collect()}
    assert all(verdict[i] for i in range(600)) and not any(verdict[i] for i in range(600, 680))
    again = {r.doc_id: r.kept for r in quality_verdicts(df.repartition(7)).collect()}
    assert again == verdict
    kept = keep_good(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(600))


def test_small_sources_are_judged_by_all_rows_of_their_language(spark):
    """Three rows beside a large source, one of them junk, and a language of one junk row."""
    rng = random.Random(9)
    junk = [" ".join(f"{ordinary(rng)[:5]}#$%|<>&*" for _ in range(90)) for _ in range(2)]
    rows = [(i, ordinary(rng), "en", "large") for i in range(400)]
    rows += [(400, ordinary(rng), "en", "small"), (401, ordinary(rng), "en", "small"), (402, junk[0], "en", "small")]
    rows += [(403, junk[1], "xx", None), (404, ordinary(rng), "yy", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in quality_verdicts(df).where("not kept").orderBy("doc_id").collect()] == [402, 403]
    assert sorted(r.doc_id for r in keep_good(df).collect()) == [i for i in range(405) if i not in (402, 403)]


@pytest.mark.parametrize("copies", [False, True])
def test_a_third_of_a_source_is_junk(spark, copies):
    rng = random.Random(10)
    junk = [" ".join(f"{ordinary(rng)[:5]}#$%|<>&*" for _ in range(90)) for _ in range(1 if copies else 120)]
    rows = [(i, ordinary(rng) if i < 240 else junk[i % len(junk)], "en", "a") for i in range(360)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(r.doc_id for r in quality_verdicts(df).where("kept").collect()) == list(range(240))


ITEMS = [(7, "a b"), (8, "B"), (9, None), (10, "!!"), (None, "é2"), (11, "q é2 a b z"), (12, "a b"), (13, "k l m n o p q r s t u v")]
TEXTS = [(1, "A b c"), (2, "x a B"), (3, None), (4, ""), (None, "q é2 a b z"), (5, "a b" * 3000), (6, "j k l-m n o p q r s t u"), (6, "z")]


@pytest.mark.parametrize("block", [1_000_000, 9])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as items")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = brute.Counter(tuple(r)[:6] for r in decontaminate.decontaminated(docs, items).collect())
    assert got == brute.Counter((doc, *brute.decontaminated(text, ITEMS)) for doc, text in TEXTS)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "6"]
    for some, other in ((docs.where("false"), items), (docs, items.where("false"))):
        assert not any(r.contaminated for r in decontaminate.decontaminated(some, other).collect())


def test_decontamination_by_long_items(spark, monkeypatch):
    """An item of more words than a block holds, and many copies of an item."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    long = [f"w{i}" for i in range(200)]
    items = [(1, " ".join(long)), *[(2, "copy of an item, " * 3)] * 30, (3, "one two")]
    texts = [(i, " ".join(["x", *long[i : i + 10], "y"])) for i in range(0, 191, 7)]
    texts += [(500, " ".join(long)), (501, " ".join(long[-22:])), (502, "one two three"), (503, " ".join(long[3:12]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    parts = list(decontaminate.blocks(docs, benchmark, 10))
    assert len(parts) > 3 and max(len(b.vocabulary) for b in parts) <= 40
    got = brute.Counter(tuple(r)[:6] for r in decontaminate.decontaminated(docs, benchmark).collect())
    assert got == brute.Counter((doc, *brute.decontaminated(text, items)) for doc, text in texts)


def test_a_block_whose_shingles_have_no_number_is_refused():
    words = " ".join(f"w{i:x}" for i in range(1 << 21)).encode()
    with pytest.raises(ValueError, match="no number"):
        decontaminate.Windows([("1", words)], 10)


def test_decontamination_of_documents(spark, documents):
    items = [(r.item_id, r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    found = decontaminate.decontaminated(
        read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "benchmark")
    )
    windows = {}
    got = {r.doc_id: tuple(r)[1:6] for r in found.collect()}
    some = [d for d in documents if got[d[0]][4]] + documents[:30]
    assert not windows and all(got[doc] == brute.decontaminated(text, items) for doc, text in some)


SPANS = [
    None, "", "a@b", "a@b@c.d x", "a@b.c@d.e%f@g.hh", "1.2.3.4.5.6.7.8", "001.2.3.4 256.1.1.1",
    "+1 (988) 555-2485, 4387513035237269.", "4387-5130-3523-7269 4387 5130 3523 7269",
    "é 4041894974608795é +49 (0) 30 12 34 56 7-", "joe (at) example.com", "9" * 300,
    "5.5.5.5@x.yy +1.2.3.4.5.6.7.8.9.0", "a@b.c " * 600, "1.1.1.1 " * 700, "𝒳 a.b@c.de 𝒳1.2.3.4",
    "+4+49 123 456 7890", " -1 -2 - 3--4", "x" * 200_000, "1 " * 60_000, "a@b.c" + ".d" * 50_000,
]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(SPANS)] + [(3, "a@b.cc"), (None, "1.2.3.4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as base", "2 as key")
    got = brute.Counter(tuple(r)[:6] for r in pii.personal_data(df).collect())
    expected = []
    for doc, text in rows:
        spans = brute.base_spans(text)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        expected.append((doc, *counts, brute.sha(brute.written(spans))))
    assert got == brute.Counter(expected)
    assert pii.personal_data(df.where("false")).isEmpty()


def test_model_adds_spans_in_other_notations(spark):
    """Cards with dots are no base spans; the model knows cards from 400 others and adds them."""
    rng = random.Random(3)

    def card(mark):
        digits = [4, *(rng.randrange(10) for _ in range(14))]
        total = sum(sum(divmod(d * (1 + (i + 1) % 2), 10)) for i, d in enumerate(digits[::-1]))
        text = "".join(map(str, [*digits, -total % 10]))
        return mark.join(text[i : i + 4] for i in range(0, 16, 4))

    rows = []
    for i in range(400):
        number = "".join(rng.choices("123456789", k=rng.choice([8, 9, 16])))
        rows.append((i, f"card {card('-')} and mail u{i}@x.example.com, ip 10.1.{i % 200}.7, code {number} end"))
    rows += [(1000, f"pay {card('.')} now"), (1001, "pay 4000.1234.1234.1239 now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert (got[1000].n_card, got[1000].n_added, got[1000].spans) == (0, 1, "card:4:23")
    assert got[1001].n_added == 0
    assert all(r.base_sha256 == brute.sha(brute.written(brute.base_spans(rows[d][1]))) for d, r in got.items() if d < 400)
    red = {r.doc_id: r for r in pii.redact(df.selectExpr("*", "0 as n_chars", "'x' as doc")).collect()}
    assert red[1000].text == "pay [CARD] now" and red[1000].n_chars == 14 and red[1000].doc == "x"
    assert "[EMAIL], ip [IP], code" in red[0].text and red[1001].n_chars == 0
