"""Drop rate, severity and threshold alerts on report rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severity limits, default thresholds, alert words.
LOW_BELOW = 0.10
MEDIUM_UP_TO = 0.30
DEFAULT_MAX_DROP_RATE = 0.5
# Counters that are watched without a table of limits; None is no limit.
DEFAULT_LIMITS = {"emails": 1000, "phones": None}
EXCEEDED, OK = "EXCEEDED", "OK"


def drop_rate(original: Column, final: Column) -> Column:
    """`1 - final / original`, in this very form: the limits are met or missed by its last bits.
    Null for an empty table."""
    return F.lit(1.0) - F.try_divide(final.cast("double"), original.cast("double"))


def severity(rate: Column) -> Column:
    return (
        F.when(rate < LOW_BELOW, "LOW")
        .when(rate <= MEDIUM_UP_TO, "MEDIUM")
        .when(rate.isNotNull(), "HIGH")
    )


def percent_label(rate: Column) -> Column:
    """Two decimals, rounded from the exact binary value and half to even: 0.03125 is `3.12%`.

    `bround` works on the shortest decimal text of a double, which may look like a tie (62.675)
    where the value is not one. Where the third decimal is 5, the sign of `value - third decimal`
    decides; it is computed without rounding by splitting the value in two short halves.
    """
    value = rate * 100
    thousandths = F.rint(value * 1000)
    scaled = value * 134217729.0
    high = scaled - (scaled - value)
    sign = F.signum((high * 1000 - thousandths) + (value - high) * 1000)
    from_five = F.floor(thousandths / 10) + (sign > 0).cast("long")
    hundredths = F.when((thousandths % 10 == 5) & (sign != 0), from_five).otherwise(
        F.rint(F.bround(value, 2) * 100).cast("long")
    )
    whole = F.floor(hundredths / 100).cast("long")
    label = F.format_string("%d.%02d%%", whole, hundredths.cast("long") - whole * 100)
    return F.when(rate.isNotNull(), label)


def score(report: DataFrame) -> DataFrame:
    """Add `drop_rate`, `drop_rate_pct` and `severity`."""
    rated = report.withColumn("drop_rate", drop_rate(F.col("original_rows"), F.col("final_rows")))
    rate = F.col("drop_rate")
    return rated.withColumns({"drop_rate_pct": percent_label(rate), "severity": severity(rate)})


def alert(value: Column, limit: Column) -> Column:
    """Strictly above the limit is too much; no limit, no alert."""
    return F.when(limit.isNotNull(), F.when(value > limit, EXCEEDED).otherwise(OK))


def strictest(thresholds: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest of its limits, and the first of its recipients by name."""
    limits = [c for c in thresholds.columns if c not in by]
    return thresholds.groupBy(*by).agg(*(F.min(c).alias(c) for c in limits))


def counted(report: DataFrame) -> list[str]:
    """Labels of the failure counters of a report, as in `invalid_<label>_dropped`."""
    pattern = re.compile(r"invalid_(\w+)_dropped")
    return [m[1] for c in report.columns if (m := pattern.fullmatch(c))]


def alerts(
    scored: DataFrame, thresholds: DataFrame | None = None, by: Sequence[str] = ("client_id",)
) -> DataFrame:
    """Add limits and alert states, from a table of limits per key or from the defaults.

    A counter of the report is watched if it has a default limit or the table has a column
    `max_invalid_<label>` for it; limits on counters that the report lacks are ignored. A key that
    occurs in several rows of the table is held to the strictest limits.

    The join carries no broadcast hint: report and limits have one row per key, so their sizes
    grow with the number of keys, and Spark broadcasts the limits only while their size allows.
    """
    given = thresholds.columns if thresholds is not None else []
    labels = [
        label
        for label in counted(scored)
        if label in DEFAULT_LIMITS or f"max_invalid_{label}" in given
    ]
    wanted = {"max_drop_rate": ("double", DEFAULT_MAX_DROP_RATE)}
    wanted |= {f"max_invalid_{x}": ("long", DEFAULT_LIMITS.get(x)) for x in labels}
    wanted |= {"recipient": ("string", None)}
    joined = scored
    if thresholds is not None:
        used = strictest(thresholds, by).select(*by, *(c for c in wanted if c in given))
        joined = scored.join(used, list(by), "left")
    limited = joined.withColumns(
        {
            name: F.coalesce(F.col(name) if name in given else F.lit(None), F.lit(default))
            .cast(kind)
            for name, (kind, default) in wanted.items()
        }
    )
    states = {"drop_rate_alert": alert(F.col("drop_rate"), F.col("max_drop_rate"))}
    states |= {
        f"invalid_{x}_alert": alert(F.col(f"invalid_{x}_dropped"), F.col(f"max_invalid_{x}"))
        for x in labels
    }
    return limited.withColumns(states)
