"""Profiles against pandas, and the boundaries where Spark's own functions differ."""

import math
import random
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
import pytest
from compare import code_sizes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable import (
    ContractError,
    correlation_of,
    merge_pairs,
    missing_of,
    pair_states,
    profile_columns,
    profile_correlation,
    profile_exact,
    profile_missing,
    profile_stats,
    profile_summary,
    stats_of,
    stats_wide,
    summary_of,
)


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(1)
    rows = [
        (
            rng.randint(0, 50),
            rng.choice([None, rng.gauss(1e6, 1)]),
            rng.choice([math.nan, rng.random()]),
            0.1,
            rng.choice([None, "x"]),
            rng.random() < 0.5,
        )
        for _ in range(500)
    ]
    names = ["n", "gaps", "nans", "constant", "s", "flag"]
    schema = "n int, gaps double, nans double, constant double, s string, flag boolean"
    return spark.createDataFrame(rows, schema).repartition(7), pd.DataFrame(rows, columns=names)


def test_missing(frames):
    df, pdf = frames
    counts = pdf.isna().sum()
    assert {r[0]: r[1] for r in profile_missing(df).collect()} == counts[counts > 0].to_dict()


def test_summary(frames):
    row = profile_summary(frames[0]).first()
    assert (row.row_count, row.column_count) == (500, 6)
    assert row.numeric_columns == ["n", "gaps", "nans", "constant"]


def test_stats(frames):
    df, pdf = frames
    got = {(r.statistic, r.column): r.value for r in profile_stats(df).collect()}
    numeric = pdf.select_dtypes(include="number")
    for statistic in ("mean", "min", "max", "sum"):
        for column, value in getattr(numeric, statistic)().items():
            assert got[statistic, column] == pytest.approx(value, rel=1e-12)
    wide = stats_wide(profile_stats(df), ["n", "gaps"])
    assert {r.statistic for r in wide.collect()} == {"mean", "min", "max", "sum"}


def test_correlation(frames):
    df, pdf = frames
    expected = pdf.select_dtypes(include="number").corr()
    rows = profile_correlation(df).collect()
    assert len(rows) == 16
    for r in rows:
        value = expected.loc[r.col_a, r.col_b]
        assert r.corr is None if math.isnan(value) else r.corr == pytest.approx(value, abs=1e-9)


def test_correlation_boundaries(spark):
    one = spark.createDataFrame([(1.0, 2.0)], ["a", "b"])
    assert [r.corr for r in profile_correlation(one).collect()] == [None] * 4
    # Constant only where both are present, in many partitions.
    rows = [(0.1, float(i), 0.1 if i % 2 else None) for i in range(99)] + [(7.0, None, 3.0)]
    df = spark.createDataFrame(rows, ["a", "b", "c"]).repartition(9)
    got = {(r.col_a, r.col_b): r.corr for r in profile_correlation(df).collect()}
    assert got["a", "b"] is None and got["c", "b"] is None
    assert got["a", "a"] == 1.0 and got["a", "c"] == pytest.approx(1.0)
    assert all(got[a, b] == got[b, a] for a, b in got)


def test_correlation_of_any_number_of_columns(spark):
    eleven = spark.createDataFrame([tuple(range(11))] * 2, [f"c{i}" for i in range(11)])
    assert profile_correlation(eleven).count() == 121
    assert profile_correlation(eleven, ["c1"]).isEmpty()
    assert profile_correlation(eleven, [f"c{i}" for i in range(10)]).count() == 100


def test_correlation_far_from_zero(spark):
    rows = [(1e12 + i, float(i % 7)) for i in range(700)]
    df = spark.createDataFrame(rows, ["a", "b"]).repartition(7)
    got = {(r.col_a, r.col_b): r.corr for r in profile_correlation(df).collect()}
    expected = np.corrcoef([i for i in range(700)], [i % 7 for i in range(700)])[0, 1]
    assert got["a", "b"] == pytest.approx(expected, abs=1e-9)


def test_correlation_of_states_of_parts(frames, spark):
    """States of parts with means far apart, and of parts that lack values, give that of the whole."""
    rows = [(float(i), i * i % 17, 1e9 + i % 5 if i % 3 else None, None if i < 50 else i % 4) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, b long, c double, d int")
    whole = {(r.col_a, r.col_b): r.corr for r in profile_correlation(df).collect()}
    parts = [pair_states(df.where(c)) for c in ("a < 30", "a >= 30 and a < 45", "a >= 45", "a < 0")]
    merged = correlation_of(merge_pairs(reduce(DataFrame.unionByName, parts)))
    got = {(r.col_a, r.col_b): r.corr for r in merged.collect()}
    assert got.keys() == whole.keys() and len(got) == 16
    for pair, value in whole.items():
        assert got[pair] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_correlation_with_infinite_values(spark):
    rows = [(float(i), float("inf") if i == 3 else float(i % 5), float(i % 3) if i != 3 else None) for i in range(40)]
    df = spark.createDataFrame(rows, ["a", "b", "c"])
    got = {(r.col_a, r.col_b): r.corr for r in profile_correlation(df).collect()}
    assert got["a", "b"] is None and got["b", "b"] is None
    assert got["b", "c"] == pytest.approx(np.corrcoef(*zip(*[(r[1], r[2]) for r in rows if r[2] is not None]))[0, 1])


def test_code_of_wide_correlation_compiles(spark):
    wide = spark.range(10).select(*((F.col("id") * k).cast("double").alias(f"c{k}") for k in range(40)))
    sizes = code_sizes(profile_correlation(wide))
    assert sizes and max(sizes) < 8000


def test_exact_values(spark):
    df = spark.createDataFrame(
        [(2**53 + 1, Decimal("0.10"), 1.5), (2**53 + 3, Decimal("12345678901234.56"), None)],
        "a long, b decimal(16,2), c double",
    )
    got = {(r.statistic, r.column): r.exact for r in profile_exact(df).collect()}
    assert got["min", "a"] == 2**53 + 1 and got["sum", "a"] == 2**54 + 4
    assert got["sum", "b"] == Decimal("12345678901234.66") and ("min", "c") not in got
    assert profile_exact(df.select("c")).isEmpty()


def _shown(df):
    """Rows as text, doubles without their last bits: sums depend on the order of the tasks."""
    return sorted(
        str([round(v, 6) if isinstance(v, float) else v for v in row]) for row in df.collect()
    )


def test_one_pass_gives_the_same_parts(frames):
    df, _ = frames
    profile = profile_columns(df)
    for one, alone in (
        (summary_of(profile), profile_summary(df)),
        (missing_of(profile), profile_missing(df)),
        (stats_of(profile), profile_stats(df)),
    ):
        assert _shown(one) == _shown(alone)
    nothing = profile_columns(df.where("false"))
    assert summary_of(nothing).isEmpty() and stats_of(nothing).isEmpty()


def test_allow_list(frames):
    df, _ = frames
    assert {r.column for r in profile_stats(df, ["n", "s"]).collect()} == {"n"}
    with pytest.raises(ContractError, match="nope"):
        profile_stats(df, ["nope"])
    assert profile_stats(df, ["s"]).isEmpty()


def test_all_missing_and_too_large_sums(spark):
    df = spark.createDataFrame([(None, 2**62), (None, 2**62), (None, 2**62)], "a double, b long")
    got = {(r.statistic, r.column): r.value for r in profile_stats(df).collect()}
    assert got["mean", "a"] is None and got["sum", "a"] == 0.0
    assert got["sum", "b"] == 3 * 2.0**62


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert profile_missing(empty).isEmpty() and profile_summary(empty).isEmpty()
    assert profile_stats(empty).isEmpty() and profile_correlation(empty).isEmpty()
