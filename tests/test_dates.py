"""Dates: literal rows, and the pandas parser as an independent reader of the same shapes."""

import random
import warnings
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dqtable import Rule, apply_rules, clean_date, register_functions
from dqtable.functions import dates

LITERAL = {
    "2024-01-05": datetime(2024, 1, 5),
    "01/05/2024": datetime(2024, 1, 5),
    "13/02/2024": datetime(2024, 2, 13),
    "2024/1/5": datetime(2024, 1, 5),
    "1/5/24": datetime(2024, 1, 5),
    "1/5/99": datetime(1999, 1, 5),
    "05-Jan-2024": datetime(2024, 1, 5),
    "Jan 5, 2024": datetime(2024, 1, 5),
    "Friday, January 5th, 2024": datetime(2024, 1, 5),
    "January 2024": datetime(2024, 1, 1),
    "2024-01": datetime(2024, 1, 1),
    "2024": datetime(2024, 1, 1),
    "20240115": datetime(2024, 1, 15),
    "20240115103000": datetime(2024, 1, 15, 10, 30),
    "2024-01-05 10:30": datetime(2024, 1, 5, 10, 30),
    "2024-01-05 10:30:15.123": datetime(2024, 1, 5, 10, 30, 15, 123000),
    "2024-01-05T10:00:00Z": datetime(2024, 1, 5, 10),
    "2024-01-05T10:00:00+02:00": datetime(2024, 1, 5, 8),
    "2024-01-05 10:30:15-0530": datetime(2024, 1, 5, 16, 0, 15),
    "1/5/2024 12:05 am": datetime(2024, 1, 5, 0, 5),
    "1/5/2024 1:05 PM": datetime(2024, 1, 5, 13, 5),
    "1/5/2024 13:05 PM": None,
    "2024-01-05 24:00": None,
    "02/30/2024": None,
    "2024-13-05": None,
    "3000-01-01": datetime(3000, 1, 1),
    "1600-01-01": datetime(1600, 1, 1),
    "Q1 2024": None,
    "janember 5, 2024": None,
    "now": None,
    "10:30": None,
    "not a date": None,
    "\x1f2024-01-05": datetime(2024, 1, 5),
    "": None,
    None: None,
}


def layered(df, span=None):
    ruled = apply_rules(df, {"d": ("v", Rule("date"))}, span)
    return {r[0]: r[1] for r in ruled.select("v", "d").collect()}


def test_literal_rows(texts, evaluate):
    assert layered(texts(LITERAL)) == LITERAL
    assert evaluate(clean_date, list(LITERAL)) == LITERAL


def test_range_is_optional(texts):
    values = ["3000-01-01", "1600-01-01", "2024-01-05"]
    got = layered(texts(values), dates.NANOSECOND_RANGE)
    assert got == {"3000-01-01": None, "1600-01-01": None, "2024-01-05": datetime(2024, 1, 5)}


def by_pandas(text):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        value = pd.to_datetime(text, errors="coerce")
    if pd.isna(value):
        return None
    return (value.tz_convert("UTC").tz_localize(None) if value.tzinfo else value).to_pydatetime()


def test_shapes_against_pandas(spark, texts):
    rng = random.Random(5)
    shapes = (
        "{Y}-{m}-{d}", "{Y}/{m}/{d}", "{m}/{d}/{Y}", "{d}/{m}/{Y}", "{m}-{d}-{Y}", "{d}.{m}.{Y}",
        "{m}/{d}/{y:02d}", "{d}-{b}-{Y}", "{d} {B} {Y}", "{b} {d}, {Y}", "{B} {d} {Y}", "{b}. {d}, {Y}",
        "{Y}-{b}-{d:02d}", "{B} {Y}", "{b}-{Y}", "{Y}-{m:02d}", "{m:02d}/{Y}", "{Y}{m:02d}{d:02d}",
        "{d:02d}{b}{Y}",
    )
    clocks = ("", "", " {H:02d}:{M:02d}", " {H}:{M:02d}:{S:02d}", " {I}:{M:02d} PM", " {I}:{M:02d}:{S:02d} AM",
              " {H:02d}:{M:02d}:{S:02d}+0{z}:30")
    names = "January February March April May June July August September October November December".split()
    values = set()
    for _ in range(1500):
        m, shape = rng.randint(0, 12), rng.choice(shapes)
        parts = {
            "Y": rng.randint(1900, 2100), "y": rng.randint(0, 75), "m": m, "d": rng.randint(1, 31),
            "B": names[max(m, 1) - 1], "b": names[max(m, 1) - 1][:3], "H": rng.randint(0, 23),
            "I": rng.randint(1, 12), "M": rng.randint(0, 59), "S": rng.randint(0, 59), "z": rng.randint(0, 9),
        }
        day_given = "{d" in shape
        values.add((shape + (rng.choice(clocks) if day_given else "")).format(**parts))
    ours = layered(texts(values))
    register_functions(spark)
    texts(values).createOrReplaceTempView("shaped_dates")
    by_sql = spark.sql("select v, dq_clean_date(v) as r from shaped_dates").collect()
    assert {r[0]: r[1] for r in by_sql} == ours
    assert {v: ours[v] for v in values} == {v: by_pandas(v) for v in values}


def test_typed_dates(spark):
    df = spark.sql("select date'2024-01-05' as d, timestamp_ntz'2024-01-05 10:00:00' as t, 20240115 as n")
    ruled = apply_rules(df, {c + "c": (c, Rule("date")) for c in "dtn"})
    assert tuple(ruled.select("dc", "tc", "nc").first()) == (
        datetime(2024, 1, 5),
        datetime(2024, 1, 5, 10),
        datetime(2024, 1, 15),
    )


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_session_zone_does_not_matter(spark, texts, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = apply_rules(texts(LITERAL), {"d": ("v", Rule("date"))})
        got = {r[0]: r[1] for r in df.select("v", F.col("d").cast("string")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {k: v and str(v)[:23] for k, v in LITERAL.items()}
