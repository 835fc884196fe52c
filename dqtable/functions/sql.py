"""The rules as temporary SQL functions; Catalyst inlines their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

from dqtable.functions import dates
from dqtable.functions.rules import EMAIL, NOT_PHONE, NUMBER, PHONE
from dqtable.functions.text import BLANKS


def _literal(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" if not c.isalnum() else c for c in text) + "'"


def register_functions(spark: SparkSession) -> None:
    """Create `dq_fix_email`, `dq_normalize_phone`, `dq_clean_numeric`, `dq_clean_date` and
    `dq_clean_text`, each from text."""

    def strip(value: str) -> str:
        return f"btrim({value}, {_literal(BLANKS)})"

    number = (
        f"regexp_extract({strip("replace(replace(v, ','), '$')")}, {_literal(NUMBER)}, 0)"
    )
    bodies = {
        "dq_fix_email": f"STRING RETURN regexp_substr(lower({strip('v')}), {_literal(EMAIL)})",
        "dq_normalize_phone": "STRING RETURN regexp_substr("
        f"regexp_replace(v, {_literal(NOT_PHONE)}, ''), {_literal(PHONE)})",
        "dq_clean_numeric": "DOUBLE RETURN (SELECT CASE WHEN n >= 0 THEN n END FROM (SELECT"
        f" CASE WHEN t != '' THEN try_cast(replace(t, '_') AS DOUBLE) END AS n"
        f" FROM (SELECT {number} AS t)))",
        "dq_clean_date": f"TIMESTAMP_NTZ RETURN {dates.date_sql('v', strip, _literal)}",
        "dq_clean_text": f"STRING RETURN nullif({strip('v')}, '')",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS {body}")
