"""Lenient, deterministic dates.

One pattern recognises every accepted shape and one `regexp_replace` rewrites it to the
`year-month-day time` text that the built-in cast reads: no formatter objects, and no exception
per miss as in a chain of `try_to_timestamp` calls. Plain ISO values skip the rewrite. Month comes
before day, and day comes first only where the month-first reading is impossible. No shape depends
on the wall clock.

The work is cut into the steps of `DATE_STEPS`. Applied as successive projections (as
`apply_rules` does) each step is computed once per row and compiled. `clean_date` is the same as a
single expression: an array of one value carries the result of each step to the next, because
plain nesting would repeat every step as often as the next one mentions it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqtable.functions.text import strip

# The span of a 64-bit count of nanoseconds around 1970.
NANOSECOND_RANGE = ("1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775")
# Two-digit years are taken from the hundred years 1976 to 2075.
FIRST_SHORT_YEAR = "76"

# English month and weekday names; `%s` names the group that keeps the short name.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    r"(?<%s>jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    r"(?:(?<=jan)uary|(?<=feb)ruary|(?<=mar)ch|(?<=apr)il|(?<=jun)e|(?<=jul)y|(?<=aug)ust"
    r"|(?<=sep)t(?:ember)?|(?<=oct)ober|(?<=nov)ember|(?<=dec)ember)?\.?"
)
_WEEKDAY = r"(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+)?"

# The accepted shapes, most specific first. Y M D are four-digit year, month and day numbers,
# y a year of four or two digits, e a two-digit number over 31 (it can only be a year), f a number
# over 12 (it can only be a day), N a spelled month, n a day with an optional ordinal ending;
# `-` stands for one separator, `_` for any run of them, `+` for at least one.
_SHAPES = (
    "Y-M-D",
    "Y-M",
    "YCc",
    "Y",
    "e-M-D",
    "f-M-y",
    "M-D-y",
    "M-Y",
    "N_n+y",
    "n_N_y",
    "Y_N_n",
    "N_Y",
    "Y_N",
)
_PARTS = {
    "Y": ("y", r"(?<%s>\d{4})"),
    "y": ("y", r"(?<%s>\d{4}|\d{2})"),
    "e": ("y", r"(?<%s>3[2-9]|[4-9]\d)"),
    "M": ("m", r"(?<%s>\d{1,2})"),
    "C": ("m", r"(?<%s>\d{2})"),
    "N": ("m", _MONTH),
    "D": ("d", r"(?<%s>\d{1,2})"),
    "c": ("d", r"(?<%s>\d{2})"),
    "f": ("d", r"(?<%s>1[3-9]|2\d|3[01])"),
    "n": ("d", r"(?<%s>\d{1,2})(?:st|nd|rd|th)?"),
}
_GAPS = {"-": r"[-/. ]", "_": r"[\s,./-]*", "+": r"[\s,./-]+"}


def _shape(index: int, shape: str) -> str:
    pieces = []
    for symbol in shape:
        if symbol in _GAPS:
            pieces.append(_GAPS[symbol])
        else:
            part, pattern = _PARTS[symbol]
            pieces.append(pattern % f"{part}{index}")
    return "".join(pieces)


def _any_of(part: str) -> str:
    """Only the groups of the matching shape hold text, so their sequence is that part."""
    symbols = {symbol for symbol, (kind, _) in _PARTS.items() if kind == part}
    return "".join(f"${{{part}{i}}}" for i, s in enumerate(_SHAPES) if symbols & set(s))


# With am or pm the hour is at most 12; `a` marks midnight's 12 and `p` the hours to move by 12.
_CLOCK = (
    r"(?:(?:(?:T|\s+)"
    r"(?:(?![\d:.]+\s*[ap]m)|(?=12[\d:.]+\s*(?:(?<a>a)|p)m)|(?=(?:0?\d|1[01]):[\d:.]+\s*(?:a|(?<p>p))m))"
    r"(?<h>\d{1,2}):(?<i>\d{1,2})(?::(?<s>\d{1,2}(?:\.\d+)?))?"
    r"\s*(?:[ap]m)?\s*(?:Z|UTC|GMT|(?<zone>[+-]\d{2}:?(?:\d{2})?))?)"
    r"|(?<=\d{8})[T ]?(?<h2>\d{2})(?<i2>\d{2})(?<s2>\d{2})?)?"
)
_DATE = (
    rf"(?i)^{_WEEKDAY}(?:{'|'.join(_shape(i, s) for i, s in enumerate(_SHAPES))}){_CLOCK}\z"
)
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)?\z"

# The most usual shape besides ISO gets a small pattern of its own: day first if it must be.
_YEAR_LAST = r"^\d{1,2}[-/. ]\d{1,2}[-/. ]\d{4}\z"
_YEAR_LAST_PARTS = (
    r"^(?:(1[3-9]|2\d|3[01])[-/. ](\d{1,2})|(\d{1,2})[-/. ](\d{1,2}))[-/. ](\d{4})\z"
)

# Trimmed text never starts with this blank, so it marks recognised values and parts them.
_MARK = "\x1f"
_REWRITTEN = (
    f"{_MARK}{_any_of('y')}-{_any_of('m')}-{_any_of('d')} ${{h}}${{h2}}:${{i}}${{i2}}:${{s}}${{s2}}"
    f"{_MARK}${{a}}${{p}}${{zone}}"
)


def _recognise(text: Column) -> Column:
    """`<mark>year-month-day time[<mark>a or p, offset]`; other text stays without a mark."""
    mark = F.lit(_MARK)
    return (
        F.when(text.rlike(_ISO), F.concat(mark, text))
        .when(
            text.rlike(_YEAR_LAST),
            F.concat(mark, F.regexp_replace(text, _YEAR_LAST_PARTS, "$5-$2$3-$1$4")),
        )
        # every accepted shape holds a digit
        .when(text.rlike("[0-9]"), F.regexp_replace(text, _DATE, _REWRITTEN))
        .otherwise(text)
    )


def _long_year(text: Column) -> Column:
    century = F.when(text.substr(2, 2) >= FIRST_SHORT_YEAR, "19").otherwise("20")
    short = text.startswith(_MARK) & (text.substr(4, 1) == "-")
    return F.when(short, F.concat(F.lit(_MARK), century, F.substr(text, F.lit(2)))).otherwise(text)


def _numbered_month(text: Column) -> Column:
    position = F.position(F.lower(text.substr(7, 3)), F.lit(MONTHS))
    number = F.floor((position + 2) / 3).cast("string")
    numbered = F.concat(text.substr(1, 6), number, F.substr(text, F.lit(10)))
    spelled = text.startswith(_MARK) & (text.substr(7, 1) >= "A")
    return F.when(spelled, numbered).otherwise(text)


def _minutes(text: Column) -> Column:
    """Minutes to add for am/pm and to take off for an offset, which leaves UTC wall time."""
    suffix = F.upper(F.substring_index(text, _MARK, -1))
    half = F.when(suffix.startswith("P"), 720).when(suffix.startswith("A"), -720).otherwise(0)
    # A midnight with that offset lies as far from UTC midnight as the offset says.
    midnight = F.concat(F.lit("1970-01-01 00:00:00"), F.ltrim(suffix, F.lit("AP")))
    offset = F.unix_seconds(midnight.try_cast("timestamp")) / 60
    return half + F.when(F.length(suffix) > 1, offset.cast("int")).otherwise(0)


def _read(text: Column) -> Column:
    """Parts that were not given leave trailing separators behind."""
    body = F.substr(text, F.lit(2))
    date = F.rtrim(F.substring_index(body, _MARK, 1), F.lit(" :-"))
    shift = F.when(body.contains(_MARK) & ~text.endswith(_MARK), _minutes(text)).otherwise(0)
    value = F.timestamp_add("MINUTE", shift, date.try_cast("timestamp_ntz"))
    return F.when(text.startswith(_MARK), value)


DATE_STEPS: tuple[Callable[[Column], Column], ...] = (
    strip,
    _recognise,
    _long_year,
    _numbered_month,
    _read,
)


def within(value: Column, span: tuple[str, str] | None) -> Column:
    """Null outside `span` (both ends included); None switches the check off."""
    if span is None:
        return value
    low, high = (F.lit(bound).cast("timestamp_ntz") for bound in span)
    return F.when((value >= low) & (value <= high), value)


def clean_date(col: Column, span: tuple[str, str] | None = None) -> Column:
    """Timestamp without zone from text, or null."""
    steps = (*DATE_STEPS, lambda value: within(value, span))
    return F.get(reduce(F.transform, steps, F.array(col)), F.lit(0))


def date_sql(value: str, strip: Callable[[str], str], literal: Callable[[str], str]) -> str:
    """`clean_date` as a SQL expression: the same steps, handed on as a one-value array. It reads
    the year-last shape with the general pattern; a test holds both against each other."""
    mark = literal(_MARK)
    shift = (
        f"transform(array(upper(substring_index(x, {mark}, -1))), s -> CASE WHEN s LIKE 'P%'"
        " THEN 720 WHEN s LIKE 'A%' THEN -720 ELSE 0 END + CASE WHEN length(s) > 1 THEN"
        " cast(unix_seconds(try_cast(concat('1970-01-01 00:00:00', ltrim('AP', s)) AS TIMESTAMP))"
        " / 60 AS INT) ELSE 0 END)[0]"
    )
    date = f"try_cast(rtrim(' :-', substring_index(substr(x, 2), {mark}, 1)) AS TIMESTAMP_NTZ)"
    steps = (
        strip("x"),
        f"CASE WHEN x RLIKE {literal(_ISO)} THEN concat({mark}, x) ELSE"
        f" regexp_replace(x, {literal(_DATE)}, {literal(_REWRITTEN)}) END",
        f"CASE WHEN startswith(x, {mark}) AND substr(x, 4, 1) = '-' THEN concat({mark},"
        f" if(substr(x, 2, 2) >= '{FIRST_SHORT_YEAR}', '19', '20'), substr(x, 2)) ELSE x END",
        f"CASE WHEN startswith(x, {mark}) AND substr(x, 7, 1) >= 'A' THEN concat(substr(x, 1, 6),"
        f" cast(floor((position(lower(substr(x, 7, 3)), '{MONTHS}') + 2) / 3) AS STRING),"
        " substr(x, 10)) ELSE x END",
        f"CASE WHEN startswith(x, {mark}) THEN timestampadd(MINUTE, CASE WHEN"
        f" contains(substr(x, 2), {mark}) AND NOT endswith(x, {mark}) THEN {shift} ELSE 0 END,"
        f" {date}) END",
    )
    return reduce(lambda array, step: f"transform({array}, x -> {step})", steps, f"array({value})") + "[0]"
