"""Report tables, run history, CSV output.

Every write replaces the directory of one run (or delivery), so a job that is repeated after a
failure leaves the same tables, not twice the rows. A run's last write is its commit record; readers
that go through `read_runs` see whole runs only.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dqtable.contract import TableContract
from dqtable.errors import EmptyResultError
from dqtable.operators.report import counted, report_aggregates


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in `spark.checkpoint.dir`; where that is unset,
    below the warehouse, which driver and executors share as well."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
    return f"{base.rstrip('/')}/dqtable-{uuid.uuid4().hex}"


def run_path(path: str, table: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/{table}/run_id={run_id}"


def write_report(tables: Mapping[str, DataFrame], path: str, run_id: str) -> dict[str, str]:
    """One parquet directory per table below `run_id=`.

    The adaptive planner merges the small partitions of a shuffle, so a report of a few rows is one
    file and a large one many.
    """
    written = {}
    for name, df in tables.items():
        written[name] = run_path(path, name, run_id)
        df.write.mode("overwrite").parquet(written[name])
    return written


COMMITS = "commits"
_COMMIT = "run string, sheets array<string>"


def begin_run(spark: SparkSession, path: str, run_id: str) -> None:
    """From now on readers do not see the run, until it is committed: it may be written anew."""
    spark.createDataFrame([], _COMMIT).write.mode("overwrite").parquet(run_path(path, COMMITS, run_id))


def commit_run(spark: SparkSession, path: str, run_id: str, sheets: Sequence[str]) -> None:
    """The last write of a run: readers see all of its sheets at once."""
    record = spark.createDataFrame([(run_id, sorted(sheets))], _COMMIT).coalesce(1)
    record.write.mode("overwrite").parquet(run_path(path, COMMITS, run_id))


def finished_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run, sheets) of the runs that were committed. Runs that stopped midway are none."""
    return spark.read.schema(_COMMIT).parquet(f"{path.rstrip('/')}/{COMMITS}")


def read_runs(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """A sheet of all finished runs, with the run in `run_id` (as text, whatever it looks like).

    Columns meet by name, as runs of drifting tables differ. What goes to the driver is the list of
    runs.
    """
    runs = finished_runs(spark, path).where(F.array_contains("sheets", sheet))
    paths = [run_path(path, sheet, r.run) for r in runs.orderBy("run").collect()]
    if not paths:
        raise EmptyResultError(f"no finished run has a sheet {sheet}")
    reader = spark.read.option("mergeSchema", "true").option("basePath", f"{path.rstrip('/')}/{sheet}")
    rows = reader.parquet(*paths).drop("run_id")
    name = F.regexp_extract(F.col("_metadata.file_path"), ".*/run_id=([^/]+)/", 1)
    return rows.select("*", F.url_decode(name).alias("run_id"))


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8"
) -> None:
    """CSV with header, quoting as `load_csv` reads it; blanks are kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def check_not_empty(df: DataFrame, name: str, where: Column | None = None) -> DataFrame:
    """The table itself; an error if it holds no row, or none that meets `where`."""
    if (df if where is None else df.where(where)).isEmpty():
        raise EmptyResultError(f"{name} was written without rows")
    return df


def observe_counts(
    flagged: DataFrame, contract: TableContract, observation: Observation
) -> DataFrame:
    """Collect the counters of the whole table in the pass that writes it.

    Exact only if no shuffle follows before the write: Spark then counts each finished write task
    once, while a repeated shuffle task would count again.
    """
    return flagged.observe(observation, *report_aggregates(contract, *counted(flagged)))
