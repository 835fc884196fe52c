"""Header names, schema drift and the contract's projection. Metadata only: no job runs here."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dqtable.contract import CORRUPT, TableContract
from dqtable.errors import ContractError
from dqtable.functions.text import null_tokens


def column_name(header: str, contract: TableContract | None = None) -> str:
    """Trimmed, lower case, blanks as underscores, then the contract's alias."""
    name = header.strip().lower().replace(" ", "_")
    return contract.aliases.get(name, name) if contract else name


def unused(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores in front until no column of the table has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def normalize_headers(df: DataFrame, contract: TableContract | None = None) -> DataFrame:
    """The table with `column_name` of each header; two headers for one column are an error."""
    named: dict[str, list[str]] = {}
    for column in df.columns:
        named.setdefault(column_name(column, contract), []).append(column)
    clashes = {name: sources for name, sources in named.items() if len(sources) > 1}
    if clashes:
        raise ContractError(f"several headers mean the same column: {clashes}")
    return df.toDF(*named)


def schema_diff(df: DataFrame, contract: TableContract) -> tuple[list[str], list[str]]:
    """(missing required columns, unexpected columns) of a table with normalised headers."""
    present = set(df.columns) - {CORRUPT}
    missing = sorted(set(contract.required) - present)
    return missing, sorted(present - set(contract.columns))


def require_columns(
    df: DataFrame, columns: Sequence[str], contract: TableContract | None = None
) -> DataFrame:
    """The table itself; an error before any job if a column is absent. The names may be written
    as headers are."""
    missing = sorted({column_name(c, contract) for c in columns} - set(df.columns))
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Contract columns in contract order: absent ones as null, others dropped or kept at the end.

    Projecting here, before rows are compared for duplicates, keeps unneeded columns out of the
    scan and out of that shuffle.
    """
    missing, extra = schema_diff(df, contract)
    absent_keys = sorted(set(contract.keys) - set(df.columns))
    if absent_keys or (missing and contract.on_missing == "error"):
        raise ContractError(f"missing required columns: {absent_keys + missing}")
    present = set(df.columns)
    columns = [
        F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c)
        for c in contract.columns
    ]
    kept = [F.col(f"`{c}`") for c in extra] if contract.extra == "keep" else []
    return df.select(*columns, *kept)


def nullable_texts(df: DataFrame, contract: TableContract) -> list[str]:
    """Columns in which a null token means null: texts, except the keys."""
    untouched = {*contract.keys, CORRUPT}
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in untouched
    ]


def normalize_nulls(df: DataFrame, contract: TableContract) -> DataFrame:
    """Null tokens to null in every text column except the keys."""
    texts = nullable_texts(df, contract)
    tokens = [F.lit(token) for token in contract.null_tokens]
    return df.withColumns({c: null_tokens(F.col(f"`{c}`"), tokens) for c in texts})


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type) of a table, to be kept with each delivery."""
    rows = [(n, f.name, f.dataType.simpleString()) for n, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def schema_changes(schemas: DataFrame, delivery: str = "run_id") -> DataFrame:
    """(delivery, column, change, before, after): what differs from the delivery before.

    `schemas` holds the `schema_table` of all deliveries, told apart by a column and in its order.
    """
    runs = schemas.select(F.col(delivery).alias("now")).distinct()
    runs = runs.withColumn("last", F.lag("now").over(Window.orderBy("now"))).where("last is not null")
    after = schemas.join(runs, schemas[delivery] == F.col("now"))
    after = after.select("now", "column", F.col("type").alias("after"))
    before = schemas.join(runs, schemas[delivery] == F.col("last"))
    before = before.select("now", "column", F.col("type").alias("before"))
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .otherwise("type changed")
    )
    both = after.join(before, ["now", "column"], "full").where(~F.col("before").eqNullSafe(F.col("after")))
    return both.select(F.col("now").alias(delivery), "column", change.alias("change"), "before", "after")
