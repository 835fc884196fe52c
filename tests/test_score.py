import random

import pytest
from pyspark.sql import functions as F

from dqtable import alerts, outbox, score
from dqtable.operators.outbox import SUBJECT_HIGH, SUBJECT_LOW, SUBJECT_MEDIUM, render, unresolved
from dqtable.operators.score import percent_label


@pytest.fixture
def scored(spark):
    def build(pairs):
        return score(spark.createDataFrame(pairs, "original_rows long, final_rows long"))

    return build


def test_severity_boundaries(scored):
    expected = {
        (10, 9): "LOW",
        (10, 7): "HIGH",
        (100, 80): "MEDIUM",
        (10, 0): "HIGH",
        (10, 10): "LOW",
        (0, 0): None,
    }
    rows = scored(list(expected)).collect()
    assert {(r[0], r[1]): r.severity for r in rows} == expected
    assert {r.drop_rate_pct for r in rows if r.original_rows == 0} == {None}


def test_percent_label_equals_python(scored, spark):
    rng = random.Random(3)
    pairs = {(o, rng.randint(0, o)) for o in (rng.choice((32, 800, 4000, 8000, 7, 99991)) for _ in range(9000))}
    pairs |= {(o, f) for o in (200, 400, 1600) for f in range(o + 1)} | {(32, 31), (10_000, 3513)}
    rows = scored(sorted(pairs)).collect()
    assert {(r[0], r[1]): r.drop_rate_pct for r in rows} == {
        (o, f): f"{1 - f / o:.2%}" for o, f in pairs
    }
    rates = [k / 100_000 for k in range(0, 100_001, 5)]
    df = spark.createDataFrame([(r,) for r in rates], "r double")
    got = df.select("r", percent_label(F.col("r")).alias("p")).collect()
    assert [r.p for r in got] == [f"{r.r:.2%}" for r in got]


REPORT = (
    "client_id string, original_rows long, invalid_emails_dropped long,"
    " invalid_phones_dropped long, final_rows long"
)


@pytest.fixture
def report(spark):
    rows = [("a", 10, 5, 5, 9), ("b", 100, 1001, 1, 80), ("c", 10, 1000, 0, 5), ("d", 10, 1, 1, 0)]
    return score(spark.createDataFrame(rows, REPORT))


def states(alerted):
    return {
        r.client_id: (r.drop_rate_alert, r.invalid_emails_alert, r.invalid_phones_alert)
        for r in alerted.collect()
    }


def test_default_thresholds_are_strict(report):
    assert states(alerts(report)) == {
        "a": ("OK", "OK", None),
        "b": ("OK", "EXCEEDED", None),
        "c": ("OK", "OK", None),
        "d": ("EXCEEDED", "OK", None),
    }


def test_thresholds_per_client(spark, report):
    limits = spark.createDataFrame(
        [("a", 0.01, 5, 4, "a@x.co"), ("b", None, None, 1, None)],
        "client_id string, max_drop_rate double, max_invalid_emails long,"
        " max_invalid_phones long, recipient string",
    )
    got = states(alerts(report, limits))
    assert got["a"] == ("EXCEEDED", "OK", "EXCEEDED")
    assert got["b"] == ("OK", "EXCEEDED", "OK")
    assert got["c"] == ("OK", "OK", None)


def test_repeated_limits_do_not_repeat_rows(spark, report):
    limits = spark.createDataFrame(
        [("a", 0.9, "b@x.co"), ("a", 0.01, "a@x.co")],
        "client_id string, max_drop_rate double, recipient string",
    )
    got = alerts(report, limits)
    assert got.count() == 4
    row = got.where("client_id = 'a'").first()
    assert (row.max_drop_rate, row.drop_rate_alert, row.recipient) == (0.01, "EXCEEDED", "a@x.co")


def test_low_subject(scored):
    low = scored([(10, 10)]).withColumn("client_id", F.lit("a"))
    assert outbox(alerts(low)).first().subject == SUBJECT_LOW


def test_outbox(report):
    rows = {r.client_id: r for r in outbox(alerts(report)).collect()}
    expected = SUBJECT_MEDIUM if rows["a"].severity == "MEDIUM" else SUBJECT_LOW
    assert rows["a"].subject == expected
    assert (rows["b"].subject, rows["d"].subject) == (SUBJECT_MEDIUM, SUBJECT_HIGH)
    assert "Drop rate: 100.00% (HIGH)" in rows["d"].body


def test_template(spark):
    df = spark.createDataFrame([("${b}", None)], "a string, b string")
    values = {"a": F.col("a"), "b": F.col("b")}
    text = "${a} $a $$ ${other} ${b} 5$"
    assert df.select(render(text, values)).first()[0] == "${b} ${b} $ ${other} None 5$"
    assert unresolved(text, values) == ["other"]
