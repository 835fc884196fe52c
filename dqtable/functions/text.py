"""Blank trimming, optional text and null tokens."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode-aware trimming removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Field texts a delimited file may use for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def strip(col: Column) -> Column:
    """Remove leading and trailing blanks; `trim` alone would only remove U+0020.

    `btrim` with a character list looks at the two ends of the value only, so it costs far less
    than a `regexp_replace` over the whole text.
    """
    return F.btrim(col, F.lit(BLANKS))


def clean_text(col: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def null_tokens(col: Column, tokens: Iterable[str | Column] = NULL_TOKENS) -> Column:
    """Null where the whole field is one of `tokens` (exact, untrimmed match)."""
    return F.when(~col.isin(*tokens), col)
