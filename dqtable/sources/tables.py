"""Columnar scans and unions of several sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqtable.contract import TableContract
from dqtable.errors import ContractError
from dqtable.operators.headers import normalize_headers, unused

SOURCE = "source"


def load_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet scan; column pruning and filters reach the files."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def tagged(df: DataFrame, source: Column, name: str = SOURCE) -> DataFrame:
    """The table with a column that says where a row comes from; a column of that name is an error."""
    if unused(name, df.columns) != name:
        raise ContractError(f"the table has a column {name}; name the tag otherwise")
    return df.withColumn(name, source)


def union_sources(
    sources: Mapping[str, DataFrame], contract: TableContract | None = None, tag: str = SOURCE
) -> DataFrame:
    """All sources as one table with their name in the column `tag`; columns meet by normalised
    name and are null where a source lacks them."""
    if not sources:
        raise ValueError("no sources")
    parts = (tagged(normalize_headers(df, contract), F.lit(name), tag) for name, df in sources.items())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
