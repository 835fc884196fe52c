"""Messages: one outbox row per report row, for a delivery service to send."""

from __future__ import annotations

import re
from collections.abc import Mapping
from string import Template

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqtable.operators.report import REPORT_VERSION

# Subject lines by severity.
SUBJECT_HIGH = "[ACTION REQUIRED] Data Quality Alert: High Drop Rate"
SUBJECT_MEDIUM = "[NOTICE] Data Quality Report: Moderate Issues"
SUBJECT_LOW = "Data Quality Report: Clean Run"

DEFAULT_TEMPLATE = """Dear ${CLIENT_NAME},

your ${EMAIL_FREQUENCY} data quality report is ready.
Rows loaded: ${ROWS_LOADED}
Rows kept: ${ROWS_CLEANED}
Drop rate: ${DROP_RATE} (${SEVERITY})
"""


def subject(level: Column) -> Column:
    return (
        F.when(level.startswith("HIGH"), SUBJECT_HIGH)
        .when(level.startswith("MEDIUM"), SUBJECT_MEDIUM)
        .otherwise(SUBJECT_LOW)
    )


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill `${NAME}` and `$NAME`; `$$` is a dollar sign, unknown names stay as they are.

    The template is cut once, at planning time, and joined with the columns, so a value that
    itself looks like a placeholder is never filled again.
    """
    pieces, end = [], 0
    for match in Template.pattern.finditer(template):
        pieces.append(F.lit(template[end : match.start()]))
        end = match.end()
        name = match.group("named") or match.group("braced")
        if match.group("escaped") is not None:
            pieces.append(F.lit("$"))
        elif name in values:
            pieces.append(F.coalesce(values[name].cast("string"), F.lit("None")))
        else:
            pieces.append(F.lit(match.group()))
    return F.concat(*pieces, F.lit(template[end:]))


def unresolved(template: str, names: Mapping[str, Column] | set[str]) -> list[str]:
    """Placeholders that `render` would leave in the text."""
    return sorted(set(re.findall(r"\$\{(\w+)\}", template)) - set(names))


def listed(names: Column) -> Column:
    """An array of names as text, `['a', 'b']`."""
    quoted = F.transform(names, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def profile_values(stats: DataFrame) -> dict[str, Column]:
    """MEAN_VALUES, MIN_VALUES and MAX_VALUES of `profile_stats` for a template, as
    `{'a': 1.0, 'b': 2.5}`: one text each, looked up by the same job that writes the messages."""

    def values(statistic: str) -> Column:
        pair = F.concat(F.lit("'"), "column", F.lit("': "), F.coalesce(F.col("value").cast("string"), F.lit("None")))
        pairs = F.array_sort(F.collect_list(F.when(F.col("statistic") == statistic, pair)))
        text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
        return stats.agg(text.alias("text")).scalar()

    return {f"{s.upper()}_VALUES": values(s) for s in ("mean", "min", "max")}


def outbox(
    alerted: DataFrame,
    template: str = DEFAULT_TEMPLATE,
    key: str = "client_id",
    frequency: str = "weekly",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Recipient, subject, body, severity and alert states per key.

    Templates may name the values below, every counter of the report, the lists of missing and
    extra columns if it has them, and what `extra` adds (see `profile_values`).
    """
    values = {
        "CLIENT_NAME": F.col(key),
        "EMAIL_FREQUENCY": F.lit(frequency),
        "ROWS_LOADED": F.col("original_rows"),
        "ROWS_CLEANED": F.col("final_rows"),
        "DROP_RATE": F.col("drop_rate_pct"),
        "SEVERITY": F.col("severity"),
        "PIPELINE_VERSION": F.lit(REPORT_VERSION),
    }
    counters = {c: F.col(c) for c in alerted.columns if c.endswith("_dropped")}
    drift = ("missing_required_columns", "extra_columns")
    counters |= {c: listed(F.col(c)) for c in drift if c in alerted.columns}
    return alerted.select(
        key,
        "recipient",
        subject(F.col("severity")).alias("subject"),
        render(template, {**counters, **values, **(extra or {})}).alias("body"),
        "severity",
        *(c for c in alerted.columns if c.endswith("_alert")),
    )
