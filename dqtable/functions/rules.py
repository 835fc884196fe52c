"""Field rules: each takes a text column and gives the standardised value, or null if invalid.

Everything is a built-in expression, so a rule runs inside whole-stage code generation and is
evaluated once per row; a flag is simply `rule(col).isNull()`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqtable.functions.text import strip

# Accepted shapes. `\z`, not `$`: Java's `$` would let a trailing newline pass.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
NOT_PHONE = r"(?U)[^\d+]+"
PHONE = r"(?U)^\+?\d{7,15}\z"

# A decimal number whose digit groups may be joined by single underscores, or infinity. The casts
# of Spark also take `1d` and `0x1p3` and refuse `1_000`, so the text is checked first. Possessive
# quantifiers: the grammar never needs to go back, and Java loops instead of recursing, so a very
# long field cannot overflow the stack.
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
NUMBER = (
    rf"^[+-]?+(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?+)?+|\.{_DIGITS})(?:[eE][+-]?+{_DIGITS})?+"
    r"|(?i:inf(?:inity)?+))\z"
)


def fix_email(col: Column) -> Column:
    """Trimmed, lower-cased address."""
    return F.regexp_substr(F.lower(strip(col)), F.lit(EMAIL))


def validate_email(col: Column) -> Column:
    return F.coalesce(F.lower(strip(col)).rlike(EMAIL), F.lit(False))


def normalize_phone(col: Column) -> Column:
    """Digits with an optional single leading `+`, 7 to 15 of them; everything else is removed."""
    return F.regexp_substr(F.regexp_replace(col, NOT_PHONE, ""), F.lit(PHONE))


def validate_phone(col: Column) -> Column:
    return F.coalesce(F.regexp_replace(col, NOT_PHONE, "").rlike(PHONE), F.lit(False))


def number_text(col: Column) -> Column:
    """Text of a number without `,`, `$` and blanks, or an empty text."""
    text = strip(F.replace(F.replace(col, F.lit(",")), F.lit("$")))
    return F.regexp_extract(text, NUMBER, 0)


def parse_number(text: Column) -> Column:
    """Double from `number_text`. The cast of a text that is no number raises inside, which costs
    far more than the pattern, so only numbers reach it."""
    return F.when(text != "", F.replace(text, F.lit("_")).try_cast("double"))


def non_negative(value: Column) -> Column:
    """Null below zero. Spark orders NaN above all values, so `>= 0` alone would keep it."""
    return F.when((value >= 0) & ~F.isnan(value), value)


NUMBER_STEPS = (number_text, parse_number, non_negative)


def clean_numeric(col: Column) -> Column:
    """Non-negative number in text."""
    return non_negative(parse_number(number_text(col)))
