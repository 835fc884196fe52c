"""Folders, tables and Arrow helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes that a Python task turns into words at once.
SLICE_BYTES = 4 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share.

    It lies below `spark.checkpoint.dir`; where that is unset, below the warehouse, which a cluster
    shares as well.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: lineage ends here, and its size is known to the planner.

    Shuffle files of the write go at its end, so a chain of such tables holds one step's at a time.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fill(column: str = "text"):
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def with_columns(df: DataFrame, added: str) -> StructType:
    """The schema of `df` and, behind it, columns given as in `n long, name string`."""
    return StructType(df.schema.fields + StructType.fromDDL(added).fields)


def pieces(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator:
    """(slice of the batch, its texts as bytes); a slice holds `limit` bytes or one longer text."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    start = size = 0
    for i in range(len(texts)):
        length = len(texts[i].as_buffer()) if texts[i].is_valid else 0
        if i > start and size + length > limit:
            yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += length
    if start < len(texts):
        yield batch.slice(start), texts.slice(start).to_pylist()


def arrays(batch: pa.RecordBatch, keep: list[str], schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch with some columns of another one and new ones, in the order of `schema`."""
    out = [
        batch.column(batch.schema.get_field_index(f.name)).cast(f.type)
        if f.name in keep
        else pa.array(columns[f.name], type=f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(out, schema=schema)
