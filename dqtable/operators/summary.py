"""Key/value sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqtable.operators.profile import PROFILE_VERSION
from dqtable.operators.report import REPORT_VERSION
from dqtable.operators.score import counted


def key_values(df: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """One row per entry of `values`, as text."""
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))
            for name, value in values.items()
        )
    )
    return df.select(*by, F.inline(pairs))


def run_summary(
    alerted: DataFrame, by: Sequence[str] = ("client_id",), version: str = REPORT_VERSION
) -> DataFrame:
    """The lines of the summary sheet. Of the counters it shows the one for emails, or, for a
    contract without that rule, every one that is watched."""
    watched = [x for x in counted(alerted) if f"max_invalid_{x}" in alerted.columns]
    # The labels of the lines.
    lines = {
        "Rows Loaded": F.col("original_rows"),
        "Rows Cleaned": F.col("final_rows"),
        "Drop Rate": F.col("drop_rate_pct"),
        "Severity": F.col("severity"),
        "Drop Rate Threshold": F.col("max_drop_rate"),
        "Drop Rate Alert": F.col("drop_rate_alert"),
    }
    for x in ["emails"] if "emails" in watched else watched:
        lines[f"Invalid {x.title()} Dropped"] = F.col(f"invalid_{x}_dropped")
        lines[f"Invalid {x.title()} Threshold"] = F.col(f"max_invalid_{x}")
        lines[f"Invalid {x.title()} Alert"] = F.col(f"invalid_{x}_alert")
    return key_values(alerted, by, lines | {"Pipeline Version": F.lit(version)})


def run_metadata(
    alerted: DataFrame, run_id: str, by: Sequence[str] = ("client_id",)
) -> DataFrame:
    """Versions, run and receiver."""
    # The labels of the lines.
    return key_values(
        alerted,
        by,
        {
            "report_version": F.lit(REPORT_VERSION),
            "analysis_version": F.lit(PROFILE_VERSION),
            "timestamp": F.lit(run_id),
            "client_name": F.col(by[0]) if by else F.lit("Unknown"),
            "recipient_email": F.coalesce(F.col("recipient"), F.lit("Unknown")),
        },
    )
