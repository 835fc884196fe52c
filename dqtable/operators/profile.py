"""Profile of any table: missing values, mean/min/max/sum, correlation. All in long form."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dqtable.errors import ContractError
from dqtable.operators.headers import unused

# Code that tasks run is sent to them, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROFILE_VERSION = "1.0"
STATISTICS = ("mean", "min", "max", "sum")
# Values of a batch that are multiplied at once.
CELLS = 1 << 20


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns (booleans are not), or those among `columns` if any are given; unknown names
    are an error."""
    if columns:
        unknown = sorted(set(columns) - set(df.columns))
        if unknown:
            raise ContractError(f"missing numeric columns: {unknown}")
    return [c for c in columns or df.columns if isinstance(df.schema[c].dataType, T.NumericType)]


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _value(df: DataFrame, name: str) -> Column:
    """The column as double, NaN as null: otherwise Spark takes NaN as the maximum."""
    value = _quoted(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def _is_missing(df: DataFrame, name: str) -> Column:
    null = _quoted(name).isNull()
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return null | F.isnan(_quoted(name))
    return null


def profile_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count, column count, numeric columns and version; no row for an empty table."""
    names = F.array(*map(F.lit, numeric_columns(df, columns))).cast("array<string>")
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            "row_count",
            F.lit(len(df.columns)).cast("long").alias("column_count"),
            names.alias("numeric_columns"),
            F.lit(PROFILE_VERSION).alias("analysis_version"),
        )
        .where("row_count > 0")
    )


def profile_missing(df: DataFrame) -> DataFrame:
    """(column, missing) where a column has missing values; one pass for all columns."""
    counts = df.agg(
        *(F.count_if(_is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns))
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("missing"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*pairs))).where("missing > 0")


def _stacked(df: DataFrame, rows: Sequence[tuple[Column, ...]], names: str) -> DataFrame:
    """One output row per entry of `rows`, for every input row.

    Grouping the stacked rows by their number keeps the generated aggregation code small (some
    hundred buffers in one method run uncompiled), and the grouping ends in the map tasks: each
    hands on at most one row per entry.
    """
    cells = [cell for row in rows for cell in row]
    return df.select(F.stack(F.lit(len(rows)), *cells).alias(*names.split()))


def _moments() -> list[Column]:
    """Mean, min, max and sum of stacked values; `whole` holds the exact value of whole numbers."""
    total = F.coalesce(F.try_sum("whole").cast("double"), F.sum("value"), F.lit(0.0))
    return [
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        total.alias("sum"),
    ]


def profile_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(statistic, column, value) over the values that are not missing.

    Whole numbers are summed exactly as long as the sum fits in 64 bits, else as doubles.
    """
    numeric = numeric_columns(df, columns)
    rows = [
        (
            F.lit(n),
            _value(df, c),
            _quoted(c).cast("long")
            if isinstance(df.schema[c].dataType, T.IntegralType)
            else F.lit(None).cast("long"),
        )
        for n, c in enumerate(numeric)
    ]
    if not rows:
        return df.limit(0).select(
            F.lit("").alias("statistic"), F.lit("").alias("column"), F.lit(0.0).alias("value")
        )
    stats = (
        _stacked(df, rows, "number value whole")
        .groupBy("number")
        .agg(*_moments())
        .withColumn("column", F.get(F.array(*map(F.lit, numeric)), F.col("number")))
    )
    return stats.unpivot("column", list(STATISTICS), "statistic", "value").select(
        "statistic", "column", "value"
    )


def stats_wide(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per statistic, one column per field. The fields are named, so no job looks for them.
    Where a field is called `statistic`, the key has underscores in front."""
    key = unused("statistic", columns)
    named = stats.withColumnRenamed("statistic", key)
    return named.groupBy(key).pivot("column", list(columns)).agg(F.first("value"))


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: number, column, numeric, rows, missing, n, exact, mean, min, max, sum.

    The summary, missing values and statistics of a table in one pass; write it once and read them
    from it, or add several up with `merge_profiles`. `n` counts the values behind the mean, `exact`
    is the sum of whole numbers where it fits in 64 bits. Without rows for an empty table.
    """
    numeric = set(numeric_columns(df))
    none = F.lit(None)
    rows = [
        (
            F.lit(n),
            _is_missing(df, c).cast("int"),
            _value(df, c) if c in numeric else none.cast("double"),
            _quoted(c).cast("long")
            if isinstance(df.schema[c].dataType, T.IntegralType)
            else none.cast("long"),
        )
        for n, c in enumerate(df.columns)
    ]
    grouped = _stacked(df, rows, "number missing value whole").groupBy("number")
    sums = grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("missing").alias("missing"),
        F.count("value").alias("n"),
        F.try_sum("whole").alias("exact"),
        *_moments(),
    )
    named = F.array(*(F.struct(F.lit(c).alias("c"), F.lit(c in numeric).alias("n")) for c in df.columns))
    return sums.withColumn("x", F.get(named, F.col("number"))).select(
        "number",
        F.col("x.c").alias("column"),
        F.col("x.n").alias("numeric"),
        "rows",
        "missing",
        "n",
        "exact",
        *STATISTICS,
    )


def merge_profiles(profiles: DataFrame, delivery: str = "run_id") -> DataFrame:
    """`profile_columns` of several deliveries, told apart by a column, as that of their union.

    Rows of a delivery that lacks a column count as missing there. Means are weighted by the values
    behind them; whole sums stay exact as long as they fit in 64 bits.
    """
    per_delivery = profiles.groupBy(delivery).agg(F.max("rows").alias("rows"))
    rows = per_delivery.agg(F.sum("rows")).scalar()
    weighted = F.sum(F.when(F.col("n") > 0, F.col("mean") * F.col("n")))
    inexact = F.count_if(F.col("exact").isNull() & (F.col("n") > 0)) > 0
    exact = F.when(~inexact, F.try_sum("exact"))
    merged = profiles.groupBy("column").agg(
        F.min("number").alias("number"),
        F.bool_or("numeric").alias("numeric"),
        (rows - F.sum(F.col("rows") - F.col("missing"))).alias("missing"),
        F.sum("n").alias("n"),
        exact.alias("exact"),
        F.try_divide(weighted, F.sum("n")).alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.coalesce(exact.cast("double"), F.sum("sum")).alias("sum"),
    )
    merged = merged.withColumn("rows", rows)
    return merged.select("number", "column", "numeric", "rows", "missing", "n", "exact", *STATISTICS)


def summary_of(profile: DataFrame) -> DataFrame:
    """`profile_summary` from a written profile."""
    names = F.array_sort(F.collect_list(F.when(F.col("numeric"), F.struct("number", "column"))))
    return (
        profile.agg(
            F.max("rows").alias("row_count"),
            F.count(F.lit(1)).alias("column_count"),
            F.transform(names, lambda x: x["column"]).alias("numeric_columns"),
            F.lit(PROFILE_VERSION).alias("analysis_version"),
        )
        .where("row_count > 0")
    )


def missing_of(profile: DataFrame) -> DataFrame:
    """`profile_missing` from a written profile."""
    return profile.where("missing > 0").select("column", "missing")


def stats_of(profile: DataFrame) -> DataFrame:
    """`profile_stats` from a written profile."""
    numeric = profile.where("numeric")
    return numeric.unpivot("column", list(STATISTICS), "statistic", "value").select(
        "statistic", "column", "value"
    )


def profile_exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(statistic, column, exact): min, max and sum of whole and decimal columns, without doubles.

    `exact` is a decimal of 38 digits with as many decimals as the finest column; a sum that needs
    more digits is null.
    """
    exact = {
        c: df.schema[c].dataType
        for c in numeric_columns(df, columns)
        if isinstance(df.schema[c].dataType, (T.IntegralType, T.DecimalType))
    }
    scale = max((t.scale for t in exact.values() if isinstance(t, T.DecimalType)), default=0)
    kind = f"decimal(38,{scale})"
    if not exact:
        nothing = F.lit("").alias("statistic"), F.lit("").alias("column")
        return df.limit(0).select(*nothing, F.lit(0).cast(kind).alias("exact"))
    rows = [(F.lit(n), _quoted(c).cast(kind)) for n, c in enumerate(exact)]
    stats = _stacked(df, rows, "number value").groupBy("number")
    stats = stats.agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.coalesce(F.try_sum("value"), F.when(F.count("value") == 0, F.lit(0)))
        .cast(kind)
        .alias("sum"),
    ).withColumn("column", F.get(F.array(*map(F.lit, exact)), F.col("number")))
    return stats.unpivot("column", ["min", "max", "sum"], "statistic", "exact").select(
        "statistic", "column", "exact"
    )


#: Per two columns: sums over the rows where both have a value, about a centre of each.
_SUMS = ("n", "spoiled", "s_a", "s_b", "q_a", "q_b", "p", "low_a", "high_a", "low_b", "high_b")
_CENTRES = ("centre_a", "centre_b")
_PAIR = ", ".join(
    ["a int, b int", *(f"{c} double" for c in _CENTRES), "n long, spoiled long"]
    + [f"{c} double" for c in _SUMS[2:]]
)


class _PairSums:
    """Sums of products of all columns with each other, batch by batch as matrix products.

    Products are of values less a centre, as products of values far from zero would lose the digits
    that tell them apart. The centre is the mean of what comes first.
    """

    def __init__(self, columns: int):
        shape = columns, columns
        self.centre = np.full(columns, np.nan)
        self.n, self.spoiled = np.zeros(shape), np.zeros(shape)
        self.s, self.q, self.p = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        self.low, self.high = np.full(shape, np.inf), np.full(shape, -np.inf)

    def add(self, values: np.ndarray) -> None:
        """`values`: rows x columns, NaN where one is missing."""
        there, wild = ~np.isnan(values), np.isinf(values)
        finite = there & ~wild
        count = finite.sum(axis=0)
        new = np.isnan(self.centre) & (count > 0)
        self.centre[new] = np.where(finite, values, 0.0).sum(axis=0)[new] / count[new]
        values = values - np.nan_to_num(self.centre)
        x, m = np.where(finite, values, 0.0), there.astype(float)
        self.n += m.T @ m
        self.spoiled += wild.T.astype(float) @ m
        self.s += x.T @ m
        self.q += (x * x).T @ m
        self.p += x.T @ x
        # columns with gaps in the same rows leave the same rows to the others
        gaps: dict[bytes, list[int]] = {}
        for b in range(values.shape[1]):
            gaps.setdefault(np.packbits(there[:, b]).tobytes(), []).append(b)
        for same in gaps.values():
            rows = values[there[:, same[0]]]
            if len(rows):
                low, high = np.fmin.reduce(rows, axis=0), np.fmax.reduce(rows, axis=0)
                self.low[:, same] = np.fmin(self.low[:, same], low[:, None])
                self.high[:, same] = np.fmax(self.high[:, same], high[:, None])

    def batch(self) -> pa.RecordBatch:
        a, b = np.triu_indices(len(self.n))
        centre = np.nan_to_num(self.centre)
        both = [centre[a], centre[b]]
        both += [(self.n[a, b]).astype(np.int64), (self.spoiled + self.spoiled.T)[a, b].astype(np.int64)]
        both += [self.s[a, b], self.s[b, a], self.q[a, b], self.q[b, a], self.p[a, b]]
        both += [self.low[a, b], self.high[a, b], self.low[b, a], self.high[b, a]]
        arrays = [pa.array(x) for x in (a.astype(np.int32), b.astype(np.int32), *both)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", *_CENTRES, *_SUMS])


def _merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of several tasks or deliveries as one: sums are moved to a common centre and added."""
    pair, n = Window.partitionBy(*keys), F.col("n")
    to = {}
    for s in "ab":
        total = F.sum(n * F.col(f"centre_{s}") + F.col(f"s_{s}")).over(pair)
        to[f"to_{s}"] = F.coalesce(F.try_divide(total, F.sum(n).over(pair)), F.lit(0.0))
    moved = states.withColumns(to)
    by = {s: F.col(f"centre_{s}") - F.col(f"to_{s}") for s in "ab"}
    moved = moved.withColumns(
        {f"q_{s}": F.col(f"q_{s}") + 2 * by[s] * F.col(f"s_{s}") + n * by[s] * by[s] for s in "ab"}
        | {"p": F.col("p") + by["a"] * F.col("s_b") + by["b"] * F.col("s_a") + n * by["a"] * by["b"]}
        | {f"s_{s}": F.col(f"s_{s}") + n * by[s] for s in "ab"}
        | {f"{end}_{s}": F.col(f"{end}_{s}") + by[s] for s in "ab" for end in ("low", "high")}
    )
    total = {c: F.sum for c in _SUMS}
    total |= {f"low_{s}": F.min for s in "ab"} | {f"high_{s}": F.max for s in "ab"}
    sums = [call(c).alias(c) for c, call in total.items()]
    centres = [F.min(f"to_{s}").alias(f"centre_{s}") for s in "ab"]
    return moved.groupBy(*keys).agg(*centres, *sums)


def pair_states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_a, col_b, centre_a, centre_b, n, ...): what correlation needs of every two columns.

    One row per two columns and per column with itself, from one pass: tasks sum matrix products over
    Arrow batches and hand on one row per two columns. States of several tables add up
    (`merge_pairs`).
    """
    numeric = numeric_columns(df, columns)
    width = len(numeric)
    if not numeric:
        texts = (F.lit("").alias(c) for c in ("col_a", "col_b"))
        counts = (F.lit(0).cast("long").alias(c) for c in _SUMS[:2])
        doubles = (F.lit(0.0).alias(c) for c in _SUMS[2:])
        centres = (F.lit(0.0).alias(c) for c in _CENTRES)
        return df.limit(0).select(*texts, *centres, *counts, *doubles)
    values = df.select(*(_quoted(c).cast("double").alias(f"v{i}") for i, c in enumerate(numeric)))

    def run(batches):
        sums, rows = _PairSums(width), 0
        for batch in batches:
            step = max(1, CELLS // width)
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sums.add(np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1))
            rows += batch.num_rows
        if rows:
            yield sums.batch()

    name = F.array(*map(F.lit, numeric))
    return _merged(values.mapInArrow(run, _PAIR), ["a", "b"]).select(
        *(F.get(name, F.col(side)).alias(f"col_{side}") for side in "ab"), *_CENTRES, *_SUMS
    )


def merge_pairs(states: DataFrame) -> DataFrame:
    """`pair_states` of several tables as that of their union."""
    return _merged(states, ["col_a", "col_b"]).select("col_a", "col_b", *_CENTRES, *_SUMS)


def correlation_of(states: DataFrame) -> DataFrame:
    """`profile_correlation` from states: both orders of every two columns."""
    n = F.col("n")
    covariance = F.col("p") - F.try_divide(F.col("s_a") * F.col("s_b"), n)
    spread = (F.col("q_a") - F.try_divide(F.col("s_a") * F.col("s_a"), n)) * (
        F.col("q_b") - F.try_divide(F.col("s_b") * F.col("s_b"), n)
    )
    # A rounding residue in the variance would pass for variation: constancy shows in the extremes.
    varies = (F.col("low_a") < F.col("high_a")) & (F.col("low_b") < F.col("high_b"))
    sound = varies & (spread > 0) & (F.col("spoiled") == 0)
    ratio = F.when(sound, F.try_divide(covariance, F.sqrt(spread)))
    corr = (
        F.when(ratio.isNull() | F.isnan(ratio), None)
        .when(F.col("col_a") == F.col("col_b"), 1.0)
        .otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))
    )
    found = states.select("col_a", "col_b", corr.alias("corr"))
    one = F.struct("col_a", "col_b", "corr")
    other = F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    same = F.col("col_a") == F.col("col_b")
    return found.select(F.inline(F.when(same, F.array(one)).otherwise(F.array(one, other))))


def profile_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_a, col_b, corr): the full Pearson matrix over rows where both values are present.

    Any number of columns; name some for a smaller matrix. Empty for fewer than two. Null where a
    column is constant, has a single value, or holds an infinite one.
    """
    numeric = numeric_columns(df, columns)
    if len(numeric) < 2:
        return df.limit(0).select(
            F.lit("").alias("col_a"), F.lit("").alias("col_b"), F.lit(0.0).alias("corr")
        )
    return correlation_of(pair_states(df, numeric))
