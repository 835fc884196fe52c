"""What a table must look like and which rule each column has to pass."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from dqtable.functions.text import NULL_TOKENS

# Rule kind -> default part of the counter name, `invalid_<label>_dropped`.
RULE_LABELS = {
    "email": "emails",
    "phone": "phones",
    "number": "numbers",
    "date": "dates",
    "not_null": "nulls",
    "unique": "repeats",
}

# Text of a record that could not be read as a row; null for all other rows.
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Rule:
    """A row whose value fails its rule is rejected.

    `not_null` fails where there is no value, `unique` in every row whose value another row has as
    well (nulls are no values; copies of a row are one row once they are dropped). Both leave the
    value as it is, and neither is part of the people contract.
    """

    kind: str
    label: str = ""

    def __post_init__(self) -> None:
        if self.kind not in RULE_LABELS:
            raise ValueError(f"unknown rule kind {self.kind!r}; one of {sorted(RULE_LABELS)}")
        if not self.label:
            object.__setattr__(self, "label", RULE_LABELS[self.kind])

    @property
    def counter(self) -> str:
        return f"invalid_{self.label}_dropped"


@dataclass(frozen=True)
class TableContract:
    """`keys` are carried along untouched (report keys, not part of the contract proper).

    `date_range` limits accepted dates, both ends included; without one any date is accepted.
    `on_missing` says whether an absent required column is added as null or is an error;
    `extra` whether columns outside the contract are dropped or kept.
    """

    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    rules: Mapping[str, Rule] = field(default_factory=dict)
    aliases: Mapping[str, str] = field(default_factory=dict)
    null_tokens: tuple[str, ...] = NULL_TOKENS
    date_range: tuple[str, str] | None = None
    on_missing: str = "null"
    extra: str = "drop"

    def __post_init__(self) -> None:
        columns = self.columns
        repeated = sorted({c for c in columns if columns.count(c) > 1})
        if repeated:
            raise ValueError(f"columns named twice in the contract: {repeated}")
        unknown = sorted(set(self.rules) - set(columns))
        if unknown:
            raise ValueError(f"rules for columns outside the contract: {unknown}")
        if self.on_missing not in ("null", "error") or self.extra not in ("drop", "keep"):
            raise ValueError("on_missing is 'null' or 'error', extra is 'drop' or 'keep'")

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.required, *self.optional)

    @property
    def counters(self) -> tuple[str, ...]:
        """Counter names in rule order, each once."""
        return tuple(dict.fromkeys(rule.counter for rule in self.rules.values()))


# The people table.
PEOPLE = TableContract(
    required=("id", "name", "email", "phone", "salary", "date_joined"),
    optional=(
        "department",
        "notes",
        "position",
        "location",
        "status",
        "manager",
        "dob",
        "gender",
        "contract_type",
        "last_updated",
    ),
    rules={
        "email": Rule("email"),
        "phone": Rule("phone"),
        "salary": Rule("number"),
        "date_joined": Rule("date"),
    },
    aliases={
        "date": "date_joined",
        "joindate": "date_joined",
        "joiningdate": "date_joined",
        "dept": "department",
        "division": "department",
        "remarks": "notes",
        "comments": "notes",
    },
)
