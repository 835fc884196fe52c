"""CSV as text columns, never inferred: a phone number keeps its zeros and its plus sign."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqtable.contract import CORRUPT, TableContract
from dqtable.errors import ContractError
from dqtable.operators.headers import normalize_headers, normalize_nulls, require_columns
from dqtable.sources.records import records
from dqtable.sources.tables import SOURCE, tagged

# A field that begins with a quote and is closed; what is left of a line may hold one that is not.
QUOTED = r'(^|,)"(?:[^"]|"")*+"(?=,|\z)'
UNCLOSED = r'(?:^|,)"'
# A separator no text holds, so that the reader hands over whole lines.
_NO_SEPARATOR = "\x01"
#: Files whose headers are read at a time.
HEADER_JOBS = 8
_FILE, _LINE = "_dq_file", "_dq_line"


def _options(encoding: str, multi_line: bool) -> dict[str, str]:
    """Quotes inside quoted fields are doubled; blanks belong to the field."""
    return {
        "encoding": encoding,
        "multiLine": str(multi_line).lower(),
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _line_options(encoding: str) -> dict[str, str]:
    """Lines as single fields."""
    return _options(encoding, False) | {"sep": _NO_SEPARATOR, "quote": "", "escape": ""}


def _first(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> list[str]:
    """The fields of the first record, read by the same parser; a job over one row."""
    first = spark.read.options(**options).csv(path).first()
    if first is None:
        raise ContractError(f"no header in {path}")
    return list(first)


def _names(fields: Sequence[str | None]) -> list[str]:
    names = [value if value is not None else f"unnamed_{i}" for i, value in enumerate(fields)]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ContractError(f"headers that occur more than once: {repeated}")
    return names


def _too_many_fields(record: Column, width: int) -> Column:
    """Short records are filled with nulls and are fine; this tells them from long ones. Commas
    belong to a field only inside quotes that begin it."""
    outside_quotes = F.when(record.contains('"'), F.regexp_replace(record, QUOTED, "$1"))
    outside_quotes = outside_quotes.otherwise(record)
    commas = F.length(outside_quotes) - F.length(F.replace(outside_quotes, F.lit(",")))
    return F.coalesce(commas >= width, F.lit(False))


def _unclosed(line: Column) -> Column:
    """Whether a field opens a quote that its line does not close. A quote within a field that does
    not begin with one is a character like others."""
    open_ = F.regexp_replace(line, QUOTED, "$1").rlike(UNCLOSED)
    return F.coalesce(F.when(line.contains('"'), open_), F.lit(False))


def _lines(reader, header: str, encoding: str):
    """A reader of lines; Spark compares each file's first line with the header and drops it."""
    schema = T.StructType([T.StructField(header, T.StringType())])
    return (
        reader.options(**_line_options(encoding))
        .option("header", True)
        .option("enforceSchema", False)
        .schema(schema)
    )


def _records(reader, names: list[str], encoding: str):
    """A reader of records that may span lines."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    return (
        reader.options(**_options(encoding, True))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # With pruned columns the parser would not see that a record has too many of them.
        .option("columnPruning", False)
        .schema(schema)
    )


def _split(
    lines: DataFrame, names: list[str], encoding: str, extra: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Fields of each line (or record), and the line itself where it is no row of the table."""
    line = F.col(f"`{lines.columns[0].replace('`', '``')}`")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    ddl = ", ".join(f"{f.name} string" for f in schema)
    parsed = F.from_csv(line, ddl, _options(encoding, multi_line))
    wrong = _too_many_fields(line, len(names)) | _unclosed(line)
    rows = lines.select(parsed.alias("f"), F.when(wrong, line).alias("wrong"), *extra)
    fields = [F.col(f"f.c{i}").alias(n) for i, n in enumerate(names)]
    return rows.select(*fields, F.col("wrong").alias(CORRUPT), *extra)


def _settle(
    rows: DataFrame, on_malformed: str, contract: TableContract | None, null_tokens: bool
) -> DataFrame:
    """Deal with malformed records, then normalise headers and, if asked, null tokens."""
    if on_malformed not in ("error", "reject"):
        raise ValueError("on_malformed is 'error' or 'reject'")
    if on_malformed == "error":
        text = F.concat(
            F.lit("too many fields, or a quote that is not closed (records that span lines need"),
            F.lit(" multi_line=True): "),
            F.col(CORRUPT),
        )
        fine = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(text).cast("boolean"))
        rows = rows.where(fine.otherwise(True)).drop(CORRUPT)
    rows = normalize_headers(rows, contract)
    return normalize_nulls(rows, contract or TableContract(required=())) if null_tokens else rows


def _malformed(rows: DataFrame, width: int) -> DataFrame:
    """Keep the record text of multi-line records only where they have too many fields."""
    # Spark refuses scans that need nothing but the record text, such as a count of the rows; the
    # mention of a field, which is never used as the text is there, makes them ordinary scans.
    record = F.coalesce(F.col(CORRUPT), F.col(f"`{rows.columns[0]}`"))
    return rows.withColumn(CORRUPT, F.when(_too_many_fields(F.col(CORRUPT), width), record))


def _catalogue(
    spark: SparkSession, path: str, encodings: Sequence[str], multi_line: bool
) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """The files below a path by encoding and header, in the order of their names.

    The header is one row per file, as the driver keeps one entry per file to plan a scan. Only where
    there is a choice of encodings is there a pass over the data: it tells per file whether all of its
    bytes are UTF-8, merged in the map tasks.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = sorted(r.path for r in listed.select("path").collect())
    other: set[str] = set()
    if len(encodings) > 1:
        lines = spark.read.option("recursiveFileLookup", "true").text(path)
        file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        valid = lines.groupBy(file.alias("file")).agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"))
        other = {r.file.split(":", 1)[-1].lstrip("/") for r in valid.where("not valid").collect()}

    def group(file: str) -> tuple[str, tuple[str, ...]]:
        encoding = encodings[file.split(":", 1)[-1].lstrip("/") in other]
        return encoding, tuple(_names(_first(spark, file, _options(encoding, multi_line))))

    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        groups = list(pool.map(group, files))
    found: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for file, key in zip(files, groups, strict=True):
        found.setdefault(key, []).append(file)
    return found


def load_csv_files(
    spark: SparkSession,
    path: str,
    encodings: Sequence[str] = ("UTF-8",),
    *,
    contract: TableContract | None = None,
    multi_line: bool = False,
    on_malformed: str = "error",
    with_source: bool | str = True,
    with_line: str = "",
    null_tokens: bool = True,
) -> DataFrame:
    """All files below a directory, whatever their headers; columns meet by normalised name and are
    null where a file lacks them. One scan per header.

    `encodings`: UTF-8 and, if given, the one in which files are read whose bytes are not all UTF-8;
    nothing is guessed beyond that. The other options are those of `load_csv`.
    """
    if not 1 <= len(encodings) <= 2 or len(encodings) == 2 and encodings[0].upper() != "UTF-8":
        raise ValueError("encodings are one, or UTF-8 and another one")
    groups = _catalogue(spark, path, encodings, multi_line)
    if not groups:
        raise ContractError(f"no files in {path}")
    parts = [
        load_csv(
            spark,
            files,
            encoding,
            contract=contract,
            multi_line=multi_line,
            on_malformed=on_malformed,
            with_source=with_source,
            with_line=with_line,
            null_tokens=null_tokens,
        )
        for (encoding, _), files in groups.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    *,
    contract: TableContract | None = None,
    required: list[str] | None = None,
    multi_line: bool = False,
    on_malformed: str = "error",
    with_source: bool | str = False,
    with_line: str = "",
    null_tokens: bool = True,
) -> DataFrame:
    """A file, a directory or a list of files with the same header (a differing one is an error; see
    `load_csv_files`).

    Files are split by lines. `multi_line`: records may span lines; files are split all the same,
    after a pass that finds the blocks that begin inside a quoted field. Only in UTF-16 and UTF-32, or
    where the header itself spans lines, a file is one task. Without `multi_line`, a line that leaves a
    quoted field open is malformed.

    `on_malformed`: what to do with such lines and with records of too many fields: "error" fails
    the job, "reject" keeps them, with their text in `_corrupt_record`, and `flag_rows` rejects them.

    `with_source`: add the path of the file a row comes from, as `source` or under the name given.
    `with_line`: add the number of the line a row begins in, from one, under the name given; records
    are read as with `multi_line`.

    `null_tokens`: read them as nulls. False leaves them to `flag_rows`, which then shows rejects
    as they were delivered.
    """
    wide = encoding.upper().replace("-", "").startswith(("UTF16", "UTF32"))
    tag = SOURCE if with_source is True else with_source
    split = (multi_line or bool(with_line)) and not wide
    if split:
        header = _first(spark, path, _line_options(encoding))[0]
        names = _names(_first(spark, path, _options(encoding, True)))
        split = len(_names(_first(spark, path, _options(encoding, False)))) == len(names)
    if with_line and not split:
        raise ValueError("lines are numbered in encodings of one byte per blank, below a header of one line")
    if split:
        lines = records(spark, path, header, encoding)
        carried = {_FILE: "file", _LINE: "line"}
        lines = lines.select("value", *(F.col(c).alias(n) for n, c in carried.items()))
        rows = _split(lines, names, encoding, list(carried), multi_line=True)
        for own, name in ((_FILE, tag), (_LINE, with_line)):
            rows = (tagged(rows, F.col(own), name) if name else rows).drop(own)
    elif multi_line or wide:
        names = _names(_first(spark, path, _options(encoding, True)))
        rows = _records(spark.read, names, encoding).csv(path)
        rows = tagged(rows, F.col("_metadata.file_path"), tag) if tag else rows
        rows = _malformed(rows, len(names))
    else:
        header = _first(spark, path, _line_options(encoding))[0]
        names = _names(_first(spark, path, _options(encoding, False)))
        lines = _lines(spark.read, header, encoding).csv(path)
        if tag:
            lines = lines.withColumn(_FILE, F.col("_metadata.file_path"))
        rows = _split(lines, names, encoding, [_FILE] if tag else [])
        if tag:
            rows = tagged(rows, F.col(_FILE), tag).drop(_FILE)
    rows = _settle(rows, on_malformed, contract, null_tokens)
    return require_columns(rows, required, contract) if required else rows


def stream_csv(
    spark: SparkSession,
    path: str,
    names: list[str],
    encoding: str = "UTF-8",
    *,
    contract: TableContract | None = None,
    multi_line: bool = False,
    on_malformed: str = "reject",
    max_files: int | None = None,
    null_tokens: bool = True,
) -> DataFrame:
    """CSV files as they are delivered to a directory, `max_files` per micro-batch if given.

    A stream must know its columns beforehand: `names` are the headers every file has to carry,
    unquoted. Malformed records are rejected unless asked otherwise: an error would stop all later
    deliveries too.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if multi_line:
        rows = _malformed(_records(reader, names, encoding).csv(path), len(names))
    else:
        rows = _split(_lines(reader, ",".join(names), encoding).csv(path), names, encoding, [])
    return _settle(rows, on_malformed, contract, null_tokens)
