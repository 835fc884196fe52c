"""Newly delivered files, each cleaned once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dqtable.contract import TableContract
from dqtable.operators.outbox import DEFAULT_TEMPLATE
from dqtable.plans.batch import run_batch


def clean_incremental(
    stream: DataFrame,
    contract: TableContract,
    path: str,
    checkpoint: str,
    *,
    by: Sequence[str] = ("client_id",),
    thresholds: DataFrame | None = None,
    template: str = DEFAULT_TEMPLATE,
    client_name: str = "Customer",
    ledger: str | None = None,
) -> StreamingQuery:
    """Run what has arrived since the last call as `run_batch` does, then stop (`availableNow`).

    Every micro-batch is a whole run: rows, report with drift, profile, alerts, messages and
    record. The checkpoint hands out every file once. A micro-batch that is repeated after a
    failure has the same number and replaces its own directories, so rows and reports end up there
    once. Copies are dropped within a micro-batch and, with a `ledger` folder, across deliveries; add
    reports up with `sum_reports`, profiles with `merge_profiles` and `merge_pairs`.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_batch(
            batch,
            contract,
            path,
            f"{batch_id:012d}",
            by=by,
            thresholds=thresholds,
            template=template,
            client_name=client_name,
            ledger=ledger,
        )

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
