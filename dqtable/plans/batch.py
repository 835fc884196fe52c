"""A whole cleaning run: one scan, one shuffle, one write; everything else reads what was written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dqtable.contract import TableContract
from dqtable.operators.clean import (
    COPIES,
    DELIVERED,
    DIGEST,
    KEPT,
    MALFORMED,
    PLACE,
    RAW,
    REASONS,
    ROW,
    bad,
    flag_rows,
    reject_rows,
)
from dqtable.operators.headers import normalize_headers, schema_diff, schema_table
from dqtable.operators.ledger import delivered_digests, record_delivery
from dqtable.operators.outbox import DEFAULT_TEMPLATE, outbox, profile_values
from dqtable.operators.profile import (
    correlation_of,
    missing_of,
    numeric_columns,
    pair_states,
    profile_columns,
    stats_of,
    stats_wide,
    summary_of,
)
from dqtable.operators.report import REPORT_VERSION, cleaning_report
from dqtable.operators.score import alerts, score
from dqtable.operators.summary import run_metadata, run_summary
from dqtable.sinks.tables import (
    begin_run,
    check_not_empty,
    commit_run,
    observe_counts,
    run_path,
    write_csv,
    write_report,
)


@dataclass(frozen=True)
class WrittenRows:
    """The flagged rows of a run, as written. Each view reads its partition and columns only."""

    flagged: DataFrame

    @property
    def clean(self) -> DataFrame:
        return self.flagged.where(KEPT).select(f"{ROW}.*")

    @property
    def rejects(self) -> DataFrame:
        return reject_rows(self.flagged)


def write_rows(flagged: DataFrame, path: str) -> WrittenRows:
    """Write flagged rows partitioned by `kept`; raw values go with the rejects only."""
    fields = flagged.schema[ROW].dataType.names
    known = {COPIES, DIGEST, PLACE, bad(MALFORMED), bad(DELIVERED), *map(bad, fields)}
    halves = flagged.select(
        ROW,
        *(c for c in flagged.columns if c in known),
        F.when(~F.col(KEPT), F.col(RAW)).alias(RAW),
        REASONS,
        KEPT,
    )
    halves.write.mode("overwrite").partitionBy(KEPT).parquet(path)
    # Read with the schema that was written: the partition column stays boolean, and a run that
    # kept no row at all is still a table.
    return WrittenRows(flagged.sparkSession.read.schema(halves.schema).parquet(path))


def run_batch(
    df: DataFrame,
    contract: TableContract,
    path: str,
    run_id: str,
    *,
    by: Sequence[str] = ("client_id",),
    thresholds: DataFrame | None = None,
    template: str = DEFAULT_TEMPLATE,
    drop_duplicates: bool = True,
    client_name: str = "Customer",
    clean_csv: bool = False,
    where: Column | str | None = None,
    time: datetime | None = None,
    ledger: str | None = None,
    place: Sequence[str] = (),
) -> dict[str, str]:
    """Clean a table and write rows, report sheets, outbox and run record; returns the paths.

    `by` names the report keys; without any, the whole table is the delivery of `client_name`.
    `clean_csv` also writes the kept rows as CSV; `where` is a condition on delivered columns;
    `time` goes to the run record (now, in UTC, if it is not given). `ledger` is a folder that holds
    the digests of all rows delivered so far: rows that another run brought count as copies. `place`
    names columns that say where a row was read, which the rejects then show. A run
    over no rows at all is an error; one that keeps none is not.

    Until the last write, the run is not among the finished ones (`read_runs`).
    """
    spark: SparkSession = df.sparkSession
    time = time or datetime.now(UTC).replace(tzinfo=None)
    totals = Observation(f"counts_{run_id}")
    begin_run(spark, path, run_id)
    seen = delivered_digests(spark, ledger, run_id) if ledger else None
    flagged = flag_rows(df, contract, drop_duplicates, where, seen, place)
    rows_path = run_path(path, "rows", run_id)
    rows = write_rows(observe_counts(flagged, contract, totals), rows_path)

    delivered = normalize_headers(df.drop(*place), contract)
    drift = schema_diff(delivered, contract)
    report = cleaning_report(rows.flagged, contract, by, drift)
    if not by:
        by = ("client_id",)
        report = report.select(F.lit(client_name).alias(by[0]), "*")
    clean = rows.clean
    paths: dict[str, str] = {}

    def written(name: str, df: DataFrame) -> DataFrame:
        """The sheet as written, read with the schema it was written with: no job looks for it."""
        paths.update(write_report({name: df}, path, run_id))
        return spark.read.schema(df.schema).parquet(paths[name])

    profile = written("profile", profile_columns(clean))
    report = check_not_empty(written("report", report), "report", F.col("original_rows") > 0)
    alerted = written("alerts", alerts(score(report), thresholds, by))
    numeric, stats = numeric_columns(clean), stats_of(profile)
    several = clean if len(numeric) > 1 else clean.select()
    pairs = written("pairs", pair_states(several))
    messages = {"REPORT_PATH": F.lit(paths["report"]), **profile_values(stats)}
    counts = totals.get
    record = spark.range(1).select(
        F.lit(run_id).alias("run"),
        F.lit(time).cast("timestamp_ntz").alias("time"),
        F.lit(rows_path).alias("rows_path"),
        F.lit(paths["report"]).alias("report_path"),
        *(F.lit(counts[c]).cast("long").alias(c) for c in ("original_rows", "final_rows")),
        F.lit(REPORT_VERSION).alias("version"),
    )
    sheets = {
        "metadata": run_metadata(alerted, run_id, by),
        "meta": summary_of(profile),
        "missing": missing_of(profile),
        "statistics": stats_wide(stats, numeric) if numeric else stats,
        "correlation": correlation_of(pairs),
        "summary": run_summary(alerted, by),
        "schema": schema_table(delivered),
        "outbox": outbox(alerted, template, by[0], extra=messages),
        "runs": score(record),
    }
    paths |= write_report(sheets, path, run_id)
    if clean_csv:
        paths["clean_csv"] = run_path(path, "clean_csv", run_id)
        write_csv(clean, paths["clean_csv"])
    if ledger:
        record_delivery(rows.flagged, ledger, run_id)
    commit_run(spark, path, run_id, [*paths, "rows"])
    return {"rows": rows_path, **paths}
