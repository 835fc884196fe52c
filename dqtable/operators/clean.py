"""Duplicates, flags, kept rows and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqtable.contract import CORRUPT, TableContract
from dqtable.functions.apply import apply_rules
from dqtable.errors import ContractError
from dqtable.functions.text import clean_text, null_tokens
from dqtable.operators.headers import (
    conform,
    normalize_headers,
    nullable_texts,
    schema_diff,
    unused,
)

COPIES = "copies"
KEPT = "kept"
ROW = "row"
RAW = "raw"
REASONS = "reject_reasons"
MALFORMED = "malformed"
# Rows that an earlier delivery held, and the column of their digests.
DELIVERED = "delivered_before"
DIGEST = "digest"
# Where a row was read.
PLACE = "place"
#: Shared values that go to every task, the most frequent ones, and bytes of the longest of them.
FREQUENT, LONGEST = 1000, 256


def bad(column: str) -> str:
    return f"bad_{column}"


def dedup_counts(df: DataFrame, name: str = COPIES) -> DataFrame:
    """Distinct rows with the number of copies of each, in a column `name`.

    One shuffle gives the rows and the counts. Copies are merged before it, in every map task, so
    a row that fills a third of the table reaches the reducers once per task.
    """
    if unused(name, df.columns) != name:
        raise ContractError(f"the table has a column {name}; name the count otherwise")
    return df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias(name))


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of a row's values as text; the length before each tells values and nulls apart."""
    texts = (c.cast("string") for c in columns)
    parts = (F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts)
    return F.unhex(F.sha2(F.concat(*parts), 256))


def mark_shared(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add, for each `{target: column}`, whether other rows have the value of `column` as well.

    Values are counted in the map tasks first. The most frequent ones, FREQUENT at most and of LONGEST
    bytes, go to every task; rows that have one are dealt out evenly while the other values are
    joined, so no task gathers the rows of a value that many share.
    """
    for target, column in columns.items():
        value = F.col(f"`{column}`")
        taken = [*df.columns, *columns]
        hot_value, hot, few_value, few, salt, place = (
            unused(f"_{n}", taken) for n in ("hot_value", "hot", "few_value", "few", "salt", "place")
        )
        counts = df.where(value.isNotNull()).groupBy(value.alias(few_value))
        counts = counts.agg(F.count(F.lit(1)).alias(few)).where(F.col(few) > 1)
        short = F.octet_length(F.col(few_value).cast("string")) <= LONGEST
        top = counts.where(short).orderBy(F.col(few).desc()).limit(FREQUENT)
        top = top.select(F.col(few_value).alias(hot_value), F.lit(True).alias(hot))
        rest = counts.select(few_value, F.lit(0).alias(salt), F.lit(True).alias(few))
        dealt = 1 + F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(1 << 20))
        alone = value.isNull() | F.col(hot).isNotNull()
        df = df.join(F.broadcast(top), value == F.col(hot_value), "left")
        df = df.withColumn(place, F.when(alone, dealt).otherwise(0).cast("int"))
        met = (value == F.col(few_value)) & (F.col(place) == F.col(salt))
        df = df.join(rest, met, "left")
        df = df.withColumn(target, F.coalesce(hot, few, F.lit(False)))
        df = df.drop(hot_value, hot, few_value, few, salt, place)
    return df


def flag_rows(
    df: DataFrame,
    contract: TableContract,
    drop_duplicates: bool = True,
    where: Column | str | None = None,
    seen: DataFrame | None = None,
    place: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct input row: `row` (cleaned columns), `raw` (the same as delivered), a
    `bad_<column>` flag per rule, `reject_reasons`, `kept` and `copies`.

    The table's columns are fields of `row` and `raw`, so none of them can meet a name of ours.
    Rows are compared as delivered: neither cleaning nor null tokens make two rows copies. Records
    that `load_csv` could not read as rows are rejected as `malformed`. `where` is a condition on
    delivered columns; it is applied first and reaches the scan. (A filter on the result cannot, as
    `kept` keeps filters from repeating the rules below it.)

    `seen` (digest): digests of rows that earlier deliveries held, see `dqtable.operators.ledger`.
    Such rows are rejected as `delivered_before` and fail nothing else; every row's digest is in the
    column `digest` then. `place` names columns that say where a row was read, such as file and line:
    they are no part of the row, and the first place of its copies goes along in `place`.
    Everything downstream (kept rows,
    rejects, report) reads this frame; when more than one of them is needed, write it once, see
    `dqtable.plans.batch`.
    """
    named = normalize_headers(df, contract)
    if where is not None:
        named = named.where(where)
    own_place = unused(f"_{PLACE}", named.columns)
    if place:
        struct = F.struct(*(F.col(f"`{c}`") for c in place))
        named = named.withColumn(own_place, struct).drop(*place)
    carried = [c for c in (CORRUPT, own_place) if c in named.columns and c not in contract.keys]
    rows = conform(named, replace(contract, keys=(*contract.keys, *carried)))
    columns = [c for c in rows.columns if c != own_place]
    # Columns the table lacks are null in every row: they join after the shuffle.
    absent = [c for c in columns if c not in named.columns]
    rows = rows.drop(*absent)
    copies = unused(COPIES, columns)
    if not drop_duplicates:
        rows = rows.withColumn(copies, F.lit(1).cast("long"))
    elif place:
        alike = rows.groupBy(*(F.col(f"`{c}`") for c in rows.columns if c != own_place))
        rows = alike.agg(F.count(F.lit(1)).alias(copies), F.min(own_place).alias(own_place))
    else:
        rows = dedup_counts(rows, copies)
    if absent:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent})

    digest = before = None
    if seen is not None:
        digest, before = (unused(n, [*columns, copies]) for n in (DIGEST, DELIVERED))
        own = row_digest([F.col(f"`{c}`") for c in columns])
        known = seen.select(F.col(DIGEST).alias("_seen")).groupBy("_seen").agg(F.lit(True).alias(before))
        rows = rows.withColumn(digest, own)
        rows = rows.join(known, F.col(digest) == F.col("_seen"), "left").drop("_seen")

    texts = nullable_texts(rows.select(*(F.col(f"`{c}`") for c in columns)), contract)
    tokens = [F.lit(token) for token in contract.null_tokens]
    clean: dict[str, str] = {}
    for column in dict.fromkeys((*contract.rules, *texts)):
        clean[column] = unused(f"_{column}", [*columns, copies, *clean.values()])
    ruled = contract.rules.keys()
    rows = rows.withColumns({clean[c]: null_tokens(F.col(f"`{c}`"), tokens) for c in texts})
    rows = apply_rules(
        rows,
        {clean[c]: (clean[c] if c in texts else c, rule) for c, rule in contract.rules.items()},
        contract.date_range,
    )
    alone = [c for c, rule in contract.rules.items() if rule.kind == "unique"]
    shared: dict[str, str] = {}
    for c in alone:
        shared[c] = unused(f"_shared_{c}", [*rows.columns, *shared.values()])
    rows = mark_shared(rows, {shared[c]: clean[c] for c in alone})
    failures = {
        c: F.col(f"`{shared[c]}`") if c in shared else F.col(f"`{clean[c]}`").isNull() for c in ruled
    }
    if CORRUPT in columns:
        # What is no row of the table has no fields that could fail their rules.
        failures = {c: failed & F.col(CORRUPT).isNull() for c, failed in failures.items()}
        failures[MALFORMED] = F.col(CORRUPT).isNotNull()
    if before:
        again = F.coalesce(F.col(f"`{before}`"), F.lit(False))
        failures = {c: failed & ~again for c, failed in failures.items()} | {DELIVERED: again}
    # The partition number never is negative: the test only makes `kept` non-deterministic, and
    # a filter on it is then not copied below the rules, where it would evaluate them again.
    kept = reduce(and_, (~failed for failed in failures.values()), F.spark_partition_id() >= 0)
    named_failures = F.array(*(F.when(failed, F.lit(c)) for c, failed in failures.items()))
    reasons = F.array_compact(named_failures.cast("array<string>"))

    def value(c: str) -> Column:
        own = F.col(f"`{clean.get(c, c)}`")
        return clean_text(own) if c in texts and c in contract.optional and c not in ruled else own

    return rows.select(
        F.struct(*(value(c).alias(c) for c in columns if c != CORRUPT)).alias(ROW),
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias(RAW),
        *(failed.alias(bad(c)) for c, failed in failures.items()),
        reasons.alias(REASONS),
        kept.alias(KEPT),
        F.col(f"`{copies}`").alias(COPIES),
        *([F.col(f"`{digest}`").alias(DIGEST)] if digest else []),
        *([F.col(f"`{own_place}`").alias(PLACE)] if place else []),
    )


def clean_rows(flagged: DataFrame) -> DataFrame:
    """Rows that passed every rule, with cleaned values."""
    return flagged.where(KEPT).select(f"{ROW}.*")


def reject_rows(flagged: DataFrame) -> DataFrame:
    """Rows that failed a rule, as delivered, with the columns at fault and, if the flagged rows have
    it, the place where each was read first."""
    where = flagged.schema[PLACE].dataType.names if PLACE in flagged.columns else []
    for name in (REASONS, *where):
        if unused(name, flagged.schema[RAW].dataType.names) != name:
            raise ContractError(f"the table has a column {name}; read `{RAW}` of the flagged rows")
    return flagged.where(~F.col(KEPT)).select(f"{RAW}.*", REASONS, *(f"{PLACE}.{n}" for n in where))


def clean_data(
    df: DataFrame, contract: TableContract, drop_duplicates: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, one-row report), both lazy."""
    from dqtable.operators.report import cleaning_report

    diff = schema_diff(normalize_headers(df, contract), contract)
    flagged = flag_rows(df, contract, drop_duplicates)
    return clean_rows(flagged), cleaning_report(flagged, contract, drift=diff)
