"""Rules over the columns of a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from dqtable.contract import Rule
from dqtable.functions import dates, rules

Step = Callable[[Column], Column]


def rule_steps(kind: str, data_type: T.DataType, date_range: tuple[str, str] | None) -> list[Step]:
    """The projections a rule consists of. A column that already is a number or a date skips the
    text steps; any other type is read through its text. Rules about presence and about other rows
    leave the value alone."""
    if kind in ("not_null", "unique"):
        return [lambda c: c]
    if kind == "number" and isinstance(data_type, T.NumericType):
        return [lambda c: rules.non_negative(c.cast("double"))]
    if kind == "date" and isinstance(
        data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)
    ):
        return [lambda c: dates.within(c.cast("timestamp_ntz"), date_range)]
    steps = {
        "email": [rules.fix_email],
        "phone": [rules.normalize_phone],
        "number": list(rules.NUMBER_STEPS),
        "date": [*dates.DATE_STEPS, lambda c: dates.within(c, date_range)],
    }[kind]
    return steps if isinstance(data_type, T.StringType) else [lambda c: c.cast("string"), *steps]


def apply_rules(
    df: DataFrame,
    targets: Mapping[str, tuple[str, Rule]],
    date_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Add each target column, `{target: (source column, rule)}`: the standardised value or null.

    Step n of all rules forms the n-th projection. A projection is not merged into the next one
    while that one mentions its columns more than once, so every pattern runs once per row.
    """
    steps = {
        target: rule_steps(rule.kind, df.schema[source].dataType, date_range)
        for target, (source, rule) in targets.items()
    }
    sources = {target: source for target, (source, _) in targets.items()}
    for n in range(max((len(s) for s in steps.values()), default=0)):
        df = df.withColumns(
            {
                target: steps[target][n](df[sources[target] if n == 0 else target])
                for target in steps
                if n < len(steps[target])
            }
        )
    return df
