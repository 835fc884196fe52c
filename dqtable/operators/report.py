"""Counters of a cleaning run, over the whole table or per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqtable.contract import TableContract
from dqtable.operators.clean import COPIES, DELIVERED, KEPT, MALFORMED, ROW, bad

REPORT_VERSION = "1.0"


def report_aggregates(
    contract: TableContract, malformed: bool = False, delivered: bool = False
) -> list[Column]:
    """The counters; `malformed` adds records that could not be read as rows, `delivered` counts
    rows of earlier deliveries among the duplicates, with all their copies.

    Failures are counted after duplicates are dropped and per rule: a row that fails two rules
    counts in both. Rules that share a label share a counter."""

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    failures = [
        total(
            sum(
                (F.col(bad(c)).cast("int") for c, r in contract.rules.items() if r.counter == name),
                F.lit(0),
            )
        ).alias(name)
        for name in contract.counters
    ]
    again = F.col(bad(DELIVERED)).cast("int") if delivered else F.lit(0)
    return [
        total(F.col(COPIES)).alias("original_rows"),
        total(F.col(COPIES) - 1 + again).alias("duplicates_dropped"),
        *failures,
        *([total(F.col(bad(MALFORMED)).cast("int")).alias(f"{MALFORMED}_dropped")] * malformed),
        total(F.col(KEPT).cast("int")).alias("final_rows"),
    ]


def counted(flagged: DataFrame) -> tuple[bool, bool]:
    """Whether a flagged table may hold malformed records, and rows of earlier deliveries."""
    return bad(MALFORMED) in flagged.columns, bad(DELIVERED) in flagged.columns


def cleaning_report(
    flagged: DataFrame,
    contract: TableContract,
    by: Sequence[str] = (),
    drift: tuple[Sequence[str], Sequence[str]] | None = None,
) -> DataFrame:
    """One row, or one per value of `by`. Counts are summed in every task before the shuffle, so
    a key that holds most rows costs no more than another. Tables that may hold malformed records
    get a counter for them: a row that failed nothing else is still accounted for.

    `drift` adds the (missing, unexpected) column names as arrays.
    """
    keys = [F.col(ROW)[c].alias(c) for c in by]
    counters = report_aggregates(contract, *counted(flagged))
    report = flagged.groupBy(*keys).agg(*counters)
    if drift is None:
        return report
    names = [F.array(*map(F.lit, side)).cast("array<string>") for side in drift]
    return report.select(
        "*",
        names[0].alias("missing_required_columns"),
        names[1].alias("extra_columns"),
        F.lit(REPORT_VERSION).alias("cleaning_version"),
    )


def sum_reports(reports: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reports of several deliveries as one: the counters add up (rates do not, so score the
    result, not the parts)."""
    counters = [
        f.name
        for f in reports.schema.fields
        if f.name.endswith(("_rows", "_dropped")) and f.name not in by
    ]
    sums = (F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counters)
    return reports.groupBy(*by).agg(*sums)
