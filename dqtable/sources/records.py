"""CSV records that span lines, read by as many tasks as a file has blocks.

Whether a line begins inside a quoted field depends on all lines before it. A line turns the state
before it into the state behind it, and so does a run of lines: a block of a file is one such function,
found in the task that reads the block. A prefix scan over the blocks of a file, one row each, gives
the state in which every block begins. A second pass joins lines to records; only the parts of records
that cross blocks are shuffled. The same scan counts the lines before each block.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqtable.errors import ContractError

# Code that tasks run is sent to them, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A quoted field up to its delimiter; what follows the closing quote belongs to it.
CLOSED = r'(^|,)"(?:[^"]|"")*+"[^,]*+'
OPEN = r'(?:^|,)"'
WHOLE, OPENS, CONTINUES = 0, 1, 2


def _ends_open(line: Column) -> Column:
    return F.regexp_replace(line, CLOSED, "$1").rlike(OPEN)


def text_lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """(value, file, start, of, block, outside, inside): lines as written, numbers of their file and
    block, and whether a quoted field is open behind a line that begins outside or inside one.
    Encodings of one byte per blank only."""
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    if encoding.upper().replace("-", "") not in ("UTF8", "USASCII", "ASCII"):
        value = F.decode(value.cast("binary"), encoding)
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = lines.select(
        value.alias("value"),
        file.alias("file"),
        start.alias("start"),
        F.xxhash64(file).alias("of"),
        F.xxhash64(file, start).alias("block"),
    )
    bare = F.regexp_replace("value", "\r\\z", "")
    quoted = F.col("value").contains('"')
    return lines.withColumns(
        {
            "outside": quoted & _ends_open(bare),
            "inside": ~quoted | _ends_open(F.concat(F.lit('"'), bare)),
        }
    )


def states(outside: np.ndarray, inside: np.ndarray, first: bool) -> np.ndarray:
    """The state behind every line: lines that end alike from both states fix it, lines that end
    open from outside and closed from inside turn it over, all others leave it."""
    fixed, turns = outside == inside, np.cumsum(outside & ~inside)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    since = turns - np.where(last >= 0, turns[last], 0)
    return np.where(last >= 0, outside[last], first) ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch):
    """(first row, last row + 1) of each block's lines in a batch."""
    start, file = batch.column("start").to_numpy(), batch.column("block").to_numpy()
    new = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
    return zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True)


def _flags(batch: pa.RecordBatch, low: int, high: int) -> list[np.ndarray]:
    return [
        batch.column(c).slice(low, high - low).to_numpy(zero_copy_only=False).astype(bool)
        for c in ("outside", "inside")
    ]


def block_states(lines: DataFrame) -> DataFrame:
    """(block, open, ends, before): per block of a file, the state in which it begins and ends, and
    the number of lines before it."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for low, high in _runs(batch) if batch.num_rows else ():
                key = batch.column("block")[low].as_py()
                place = [batch.column(c)[low].as_py() for c in ("of", "start")]
                own = found.setdefault(key, [*place, 0, False, True])
                flags = _flags(batch, low, high)
                own[2] += high - low
                own[3:] = [bool(states(*flags, state)[-1]) for state in own[3:]]
        columns = list(zip(*([key, *own] for key, own in found.items()), strict=True)) or [[]] * 6
        kinds = [pa.int64()] * 4 + [pa.bool_()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["block", "of", "start", "lines", "closed_to", "open_to"]
    small = lines.select("block", "of", "start", "outside", "inside")
    schema = "block long, of long, start long, lines long, closed_to boolean, open_to boolean"
    blocks = small.mapInArrow(run, schema)
    order = Window.partitionBy("of").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("closed_to") == F.col("open_to")
    blocks = blocks.withColumn("turns", F.sum((~fixed & F.col("closed_to")).cast("int")).over(order))
    last = F.last(F.when(fixed, F.struct("closed_to", "turns")), ignorenulls=True).over(before)
    count = F.coalesce(F.sum("lines").over(before), F.lit(0))
    blocks = blocks.withColumns({"last": last, "before": count, "earlier": F.lag("turns").over(order)})
    turned = F.coalesce("earlier", F.lit(0)) - F.coalesce(F.col("last.turns"), F.lit(0))
    state = F.coalesce(F.col("last.closed_to"), F.lit(False)) != (turned % 2 == 1)
    ends = F.when(state, F.col("open_to")).otherwise(F.col("closed_to"))
    return blocks.select("block", state.alias("open"), ends.alias("ends"), "before")


class _Block:
    """The lines of a block, joined to records as they come."""

    def __init__(self, block: int, start: int, file: str, first: bool, before: int):
        self.block, self.start, self.file = block, start, file
        self.open, self.line = first, before
        self.kind = CONTINUES if first else WHOLE
        self.held: list[bytes] = []
        self.held_line = before

    def add(self, values: list[bytes], flags: list[np.ndarray]):
        """(kind, line, record) of the records that end in these lines."""
        behind = states(*flags, self.open)
        if not self.held and not self.open and not behind.any():
            # the usual case: each line is a record
            yield from ((WHOLE, self.line + i, v) for i, v in enumerate(values))
        else:
            for i, (value, state) in enumerate(zip(values, behind.tolist(), strict=True)):
                if not self.held:
                    self.held_line = self.line + i
                self.held.append(value)
                if not state:
                    yield self.kind, self.held_line, b"\n".join(self.held)
                    self.held, self.kind = [], WHOLE
        self.line += len(values)
        self.open = bool(behind[-1])

    def rest(self):
        """What is left open at the block's end."""
        if self.held:
            yield CONTINUES if self.kind == CONTINUES else OPENS, self.held_line, b"\n".join(self.held)


def records(spark: SparkSession, path: str | list[str], header: str, encoding: str) -> DataFrame:
    """(value, file, line): the records of all files, without headers and empty lines.

    `line` counts from one. What goes to every task is one number and one flag per block that a file
    is read in, as many as the driver plans tasks for.
    """
    lines = text_lines(spark, path, encoding)
    found = block_states(lines).collect()
    sent = spark.sparkContext.broadcast({r.block: (r.open, r.before) for r in found})
    crossing = [r.block for r in found if r.open or r.ends]
    head = header.encode()

    def run(batches):
        current: _Block | None = None
        names = ["kind", "line", "value", "block", "start", "file"]
        for batch in batches:
            out: list[tuple] = []
            for low, high in _runs(batch) if batch.num_rows else ():
                block, start = (batch.column(c)[low].as_py() for c in ("block", "start"))
                file = batch.column("file")[low].as_py()
                if current is None or current.block != block:
                    if current is not None:
                        out += [(*r, current.block, current.start, current.file) for r in current.rest()]
                    current = _Block(block, start, file, *sent.value[block])
                values = batch.column("value").slice(low, high - low).cast(pa.binary()).to_pylist()
                flags = _flags(batch, low, high)
                for kind, line, value in current.add(values, flags):
                    if kind == WHOLE and line == 0:
                        if value.rstrip(b"\r").removeprefix(b"\xef\xbb\xbf") != head:
                            raise ContractError(f"{file} has another header: {value[:200]!r}")
                    elif kind != WHOLE or value not in (b"", b"\r"):
                        out.append((kind, line, value, block, start, file))
            yield _batch(out, names)
        if current is not None:
            yield _batch([(*r, current.block, current.start, current.file) for r in current.rest()], names)

    schema = "kind int, line long, value string, block long, start long, file string"
    rows = lines.mapInArrow(run, schema).where(F.col("kind") == WHOLE).select("value", "file", "line")
    if crossing:
        parts = lines.where(F.col("block").isin(crossing)).mapInArrow(run, schema)
        rows = rows.unionAll(_stitched(parts.where(F.col("kind") != WHOLE)))
    text = F.regexp_replace("value", "\r\\z", "")
    return rows.select(text.alias("value"), "file", (F.col("line") + 1).alias("line"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
    arrays[2] = arrays[2].view(pa.string())  # bytes that are no UTF-8 stay as they are
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _stitched(parts: DataFrame) -> DataFrame:
    """Records that cross blocks, two parts per block at most."""
    order = Window.partitionBy("file").orderBy("start", "line")
    record = F.sum((F.col("kind") == OPENS).cast("int")).over(order)
    grouped = parts.withColumn("record", record).groupBy("file", "record")
    ordered = F.array_sort(F.collect_list(F.struct("line", "value")))
    joined = grouped.agg(ordered.alias("parts"), F.min("line").alias("line"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return joined.select(text.alias("value"), "file", "line")
