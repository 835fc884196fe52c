"""Run a query in Spark and its SQL in DuckDB and compare the rows, whatever their order."""

from __future__ import annotations

import contextlib
import io
import math
import re
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def code_sizes(df) -> list[int]:
    """Bytes of the largest method of each generated class."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.select("*").explain("codegen")
    finally:
        conf.set("spark.sql.adaptive.enabled", "true")
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
