"""Field rules against literal tables and against plain Python readings of the same rules."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F
from test_dates import LITERAL

from dqtable import (
    Rule,
    apply_rules,
    clean_date,
    clean_numeric,
    clean_text,
    fix_email,
    normalize_phone,
    null_tokens,
    register_functions,
    strip,
    validate_email,
    validate_phone,
)
from dqtable.functions.text import BLANKS, NULL_TOKENS

EMAILS = {
    " A@X.co\t": "a@x.co",
    "a..b@x.co": "a..b@x.co",
    "a@x": None,
    "a@x.c": None,
    "a b@x.co": None,
    "@x.co": None,
    "a@x.co\n": "a@x.co",
    "a@x.co\nb": None,
    " a@x.co ": "a@x.co",
    "ü@x.co": None,
    "a%+-_.1@s.x-y.museum": "a%+-_.1@s.x-y.museum",
    "": None,
    None: None,
}
PHONES = {
    "(+254) 712-345 678": "+254712345678",
    "07+12345678": None,
    "++12345678": None,
    "555-1234 x12": "555123412",
    "123456": None,
    "1234567": "1234567",
    "123456789012345": "123456789012345",
    "+123456789012345": "+123456789012345",
    "1234567890123456": None,
    "+": None,
    "٠١٢٣٤٥٦٧": "٠١٢٣٤٥٦٧",
    "": None,
    None: None,
}
NUMBERS = {
    "1_000": 1000.0,
    "1__0": None,
    "1_": None,
    "_1": None,
    "1d": None,
    "1.0f": None,
    "0x1p3": None,
    "nan": None,
    "inf": math.inf,
    "+Infinity": math.inf,
    "-inf": None,
    ".5": 0.5,
    "5.": 5.0,
    ".": None,
    "1e1_0": 1e10,
    "1e3": 1000.0,
    "1e": None,
    " $1,200.50 ": 1200.5,
    "1,5": 15.0,
    "(100)": None,
    "€5": None,
    "-0": -0.0,
    "-5": None,
    "1e999": math.inf,
    "1 000": None,
    "1._5": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize(
    ("function", "expected"),
    [(fix_email, EMAILS), (normalize_phone, PHONES), (clean_numeric, NUMBERS)],
)
def test_literal_rows(evaluate, function, expected):
    assert evaluate(function, list(expected)) == expected


def test_validity_is_never_null(evaluate):
    assert evaluate(validate_email, list(EMAILS)) == {k: v is not None for k, v in EMAILS.items()}
    assert evaluate(validate_phone, list(PHONES)) == {k: v is not None for k, v in PHONES.items()}


def test_layers_equal_single_expressions(texts):
    for kind, function, values in (
        ("email", fix_email, EMAILS),
        ("phone", normalize_phone, PHONES),
        ("number", clean_numeric, NUMBERS),
    ):
        df = apply_rules(texts(values), {"layered": ("v", Rule(kind))})
        rows = df.select("layered", function(F.col("v")).alias("single")).collect()
        assert [r[0] for r in rows] == [r[1] for r in rows]


def test_numbers_against_python(evaluate):
    rng = random.Random(7)
    alphabet = ["0", "1", "9", "_", ".", "e", "E", "+", "-", ",", "$", " ", "inf", "nan", "d", "x"]
    values = {"".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(4000)}

    def read(text):
        try:
            number = float(text.replace(",", "").replace("$", "").strip())
        except ValueError:
            return None
        return number if number >= 0 else None

    assert evaluate(clean_numeric, values) == {v: read(v) for v in values}


def test_phones_against_python(evaluate):
    rng = random.Random(8)
    values = {"".join(rng.choices("0123456789+ -()x", k=rng.randint(1, 22))) for _ in range(3000)}

    def read(text):
        kept = re.sub(r"[^\d+]", "", text)
        return kept if re.fullmatch(r"\+?\d{7,15}", kept) else None

    assert evaluate(normalize_phone, values) == {v: read(v) for v in values}


def test_blanks_are_those_of_python(evaluate):
    assert set(BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    values = [f"{b}x y{b}" for b in BLANKS]
    assert set(evaluate(strip, values).values()) == {"x y"}


def test_long_field_does_not_overflow_the_stack(evaluate):
    text = "1" + "_1" * 100_000
    assert evaluate(clean_numeric, [text])[text] == math.inf


def test_text_and_null_tokens(evaluate):
    assert evaluate(clean_text, [" a ", "  ", "", None]) == {" a ": "a", "  ": None, "": None, None: None}
    values = [*NULL_TOKENS, " NA", "na", "x"]
    kept = {k: v for k, v in evaluate(null_tokens, values).items() if v is not None}
    assert kept == {" NA": " NA", "na": "na", "x": "x"}


def test_sql_functions_equal_the_columns(spark, texts):
    register_functions(spark)
    for name, function, values in (
        ("dq_fix_email", fix_email, EMAILS),
        ("dq_normalize_phone", normalize_phone, PHONES),
        ("dq_clean_numeric", clean_numeric, NUMBERS),
        ("dq_clean_date", clean_date, LITERAL),
        ("dq_clean_text", clean_text, [" a ", "  ", "", " b "]),
    ):
        df = texts(values)
        df.createOrReplaceTempView("texts_to_clean")
        by_sql = spark.sql(f"select v, {name}(v) as r from texts_to_clean").collect()
        by_column = df.select("v", function(df["v"])).collect()
        assert {r[0]: r[1] for r in by_sql} == {r[0]: r[1] for r in by_column}


def test_typed_columns_skip_the_text_steps(spark):
    df = spark.sql("select * from values (1.5D, 1), (-1D, 2), (double('nan'), -3) as t(x, n)")
    ruled = apply_rules(df, {"cx": ("x", Rule("number")), "cn": ("n", Rule("number"))})
    assert [tuple(r) for r in ruled.select("cx", "cn").collect()] == [
        (1.5, 1.0),
        (None, 2.0),
        (None, None),
    ]


def test_unknown_rule_kind():
    with pytest.raises(ValueError, match="unknown rule kind"):
        Rule("zip")
