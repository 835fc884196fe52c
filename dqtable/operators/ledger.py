"""Copies across deliveries: a ledger of the digests of all rows delivered so far, and of all
messages posted.

The ledger is a table partitioned by the delivery that brought a row first and, below, by the first
digit of the digest. A delivery adds files of its own for its new digests and touches no others; done
again, it replaces just these, as its own digests do not count as seen.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqtable.operators.clean import DELIVERED, DIGEST, bad, row_digest

_SCHEMA = f"{DIGEST} binary, batch string, prefix string"


def delivered_digests(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """(digest): rows that other deliveries than `batch` brought first."""
    try:
        ledger = spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{DIGEST} binary")
    return ledger.where(F.col("batch") != batch).select(DIGEST)


def record_delivery(flagged: DataFrame, path: str, batch: str) -> None:
    """Add the digests of a delivery's new rows, kept or rejected, to the ledger.

    `flagged` is what `flag_rows` gives with `seen`, as written. Each digest is in the ledger once.
    """
    new = flagged.where(~F.col(bad(DELIVERED))).select(
        DIGEST,
        F.lower(F.substring(F.hex(DIGEST), 1, 1)).alias("prefix"),
    )
    new.write.mode("overwrite").partitionBy("prefix").parquet(f"{path.rstrip('/')}/batch={batch}")


def post_messages(messages: DataFrame, path: str, run_id: str) -> None:
    """Add messages to the outbox below `path`, but for those that other runs have posted.

    The same run replaces what it has posted, so a client gets a message once, and another one only
    when something in it has changed.
    """
    own = messages.withColumn(DIGEST, row_digest([F.col(f"`{c}`") for c in messages.columns]))
    sent = delivered_digests(messages.sparkSession, path, run_id)
    new = own.join(sent, DIGEST, "left_anti")
    new.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={run_id}")
