"""Repeated windows of a fixed length, found by content-defined anchors.

A text is a sequence of units (bytes or words). Of the grams (short windows) inside each window, the
one with the smallest hash is the window's anchor. Equal windows have equal anchors at equal offsets,
so a window can repeat only if its anchor's gram does, and of all positions only the anchors (about
one in thirty bytes) ever leave the task. Exact copies of whole texts are set aside before.

The result names, per text, the anchors whose gram repeats (`marks`), the windows that start here
first (`owned`, as start and count), and whether the text is a later copy of another (`copy`). A
window is removable if its anchor is marked and it is not owned. Positions count from the text's
start. Texts are told apart by a row number; the order is by doc_id (null first), then row number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import fill, pieces, stored

_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_SLICE = 1 << 18
_POWERS: dict[str, np.ndarray] = {}
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits, in place."""
    spare = np.empty_like(x)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        np.right_shift(x, np.uint64(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor > 1:
            np.multiply(x, np.uint64(factor), out=x)
    return x


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, kept for the task's next texts."""
    if len(_POWERS.get("power", ())) < count:
        size = max(count, _SLICE)
        for name, base in (("power", int(_ODD)), ("inverse", pow(int(_ODD), -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["power"][:count], _POWERS["inverse"][:count]


def run_hash(units: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` units, by sums of powers; as long as `units`, filled up.

    Runs that collide only cost work later: contents decide.
    """
    if len(units) < length:
        return np.full(len(units), _TOP)
    power, inverse = _powers(len(units))
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * power, out=total[1:])
    out = np.full(len(units), _TOP)
    run = out[: len(units) - length + 1]
    np.subtract(total[length:], total[:-length], out=run)
    np.multiply(run, inverse[: len(run)], out=run)
    _mix(run)
    np.bitwise_or(run, np.uint64(1), out=run)
    return out


def _sliding(pick: Callable, a: np.ndarray, width: int) -> np.ndarray:
    size, out, count = 1, a, len(a) - width + 1
    while 2 * size <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[:count], out[width - size : width - size + count])


@dataclass(frozen=True)
class Spec:
    """Windows of `window` units with anchors of `gram` units; anchors are extended to twice that."""

    unit: str  # byte or word
    window: int
    gram: int

    @property
    def width(self) -> int:
        """Grams per window."""
        return self.window - self.gram + 1


class Texts:
    """Some texts, one after another, as units; their grams and anchors are found when asked for.

    `parts`: per text, its bytes or its list of words.
    """

    def __init__(self, spec: Spec, parts: list):
        self.spec, self.parts = spec, parts
        self.length = np.array([len(p) for p in parts], np.int64)
        self.start = np.r_[0, np.cumsum(self.length)][:-1].astype(np.int64)
        if spec.unit == "byte":
            self.words, self.data = None, b"".join(parts)
        else:
            self.words = [w for words in parts for w in words]

    @classmethod
    def of(cls, spec: Spec, texts: list[bytes]) -> Texts:
        return cls(spec, texts if spec.unit == "byte" else [t.split() for t in texts])

    @cached_property
    def grams(self) -> np.ndarray:
        if self.words is None:
            units = _BYTES[np.frombuffer(self.data, np.uint8)]
        else:
            digests = map(xxhash.xxh3_64_intdigest, self.words)
            units = np.fromiter(digests, np.uint64, len(self.words))
        return run_hash(units, self.spec.gram)

    @cached_property
    def least(self) -> np.ndarray:
        """The smallest gram of the window at each position; zero where no window fits its text."""
        if len(self.grams) < self.spec.width:
            return self.grams[:0]
        out = _sliding(np.minimum, self.grams, self.spec.width)
        for start, length in zip(self.start.tolist(), self.length.tolist(), strict=True):
            out[start + max(0, length - self.spec.window + 1) : start + length] = 0
        return out

    @cached_property
    def anchor(self) -> np.ndarray:
        """Flags of the positions that are the smallest gram of some window."""
        if not len(self.least):
            return np.zeros(len(self.grams), bool)
        edge = np.zeros(self.spec.width - 1, np.uint64)
        around = np.concatenate([edge, self.least, edge])
        return _sliding(np.maximum, around, self.spec.width) == self.grams

    def content(self, a: int, b: int) -> bytes:
        return self.data[a:b] if self.words is None else b" ".join(self.words[a:b])

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The text that each position lies in."""
        return np.searchsorted(self.start, positions, "right") - 1

    def mark(self, marks: list[list[int]]) -> np.ndarray:
        """The positions that `marks` names, per text from its start."""
        if not marks:
            return np.zeros(0, np.int64)
        own = [np.asarray(m, np.int64) + s for m, s in zip(marks, self.start.tolist(), strict=True)]
        return np.concatenate(own)

    def candidates(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose (first) anchor is marked, and those anchors."""
        if not len(marked) or not len(self.least):
            return marked[:0], marked[:0]
        flags = np.zeros(len(self.grams), bool)
        flags[marked] = True
        edge = np.zeros(len(self.grams) + 1, np.int32)
        np.add.at(edge, np.maximum(marked - self.spec.width + 1, 0), 1)
        np.add.at(edge, marked + 1, -1)
        near = np.cumsum(edge)[: len(self.least)] > 0
        window = np.flatnonzero(near & (self.least > 0))
        places = np.flatnonzero(self.anchor)
        at = (np.cumsum(self.anchor) - self.anchor)[window]  # anchors before the window
        while len(wrong := np.flatnonzero(self.grams[places[at]] != self.least[window])):
            at[wrong] += 1
        keep = flags[places[at]]
        return window[keep], places[at[keep]]


def numbered(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, text): rows with a number that each scan of the same files gives again."""
    return docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        fill().alias("text"),
    )


def _scan(docs: DataFrame, spec: Spec) -> DataFrame:
    """Per text, its digest, length and anchors."""

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text", _SLICE):
                own = Texts.of(spec, texts)
                places = np.flatnonzero(own.anchor)
                doc = own.text_of(places)
                at = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                first = own.start[doc]
                columns = [
                    part.column("uid"),
                    part.column("doc_id"),
                    pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                    pa.array(own.length),
                    pa.ListArray.from_arrays(at, own.grams[places].view(np.int64)),
                    pa.ListArray.from_arrays(at, (places - first).astype(np.int32)),
                ]
                names = ["uid", "doc_id", "digest", "n", "grams", "places"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(
        run, "uid long, doc_id long, digest binary, n long, grams array<long>, places array<int>"
    )


def _contexts(docs: DataFrame, spec: Spec) -> DataFrame:
    """Per marked anchor, the run of units that its windows cover, keyed by the doubled gram.

    The gram is doubled to the right where the window holds that (offset up to `reach`), else to
    both sides; every window belongs to exactly one of these keys, and equal windows to equal ones.
    """
    reach = spec.window - 2 * spec.gram

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text", _SLICE):
                own = Texts.of(spec, texts)
                window, place = own.candidates(own.mark(part.column("marks").to_pylist()))
                if not len(window):
                    continue
                left = place - window > reach
                group = place * 2 + left
                # windows of a text and anchor are neighbours, first those that double to both sides
                cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                first, last = window[cut], window[np.r_[cut[1:], len(window)] - 1]
                at = place[cut] - np.where(left[cut], spec.gram, 0)
                key = _mix(own.grams[at] + left[cut]) * _ODD + own.grams[at + spec.gram]
                key = key.view(np.int64)
                doc = own.text_of(first)
                spans = zip(first.tolist(), (last + spec.window).tolist(), strict=True)
                columns = [
                    pa.array(key),
                    pa.array((place[cut] - first).astype(np.int32)),
                    pa.array([own.content(a, b) for a, b in spans], pa.binary()),
                    pa.array((last - first + 1).astype(np.int32)),
                    part.column("doc_id").take(pa.array(doc)),
                    part.column("uid").take(pa.array(doc)),
                    pa.array((first - own.start[doc]).astype(np.int64)),
                ]
                names = ["key", "lead", "content", "windows", "doc_id", "uid", "start"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(
        run,
        "key long, lead int, content binary, windows int, doc_id long, uid long, start long",
    )


def repeated(
    docs: DataFrame,
    spec: Spec,
    owners: Callable[[DataFrame, Spec], DataFrame],
    folder: str,
) -> DataFrame:
    """(uid, marks, owned, copy) for every row of `docs` (uid, doc_id, text) that has any of them.

    `owners` turns distinct contexts (key, lead, content, windows, first, n) into the windows that
    start somewhere first: (uid, start, windows). Counts are merged in the map tasks, and what is
    joined back are plain joins, so a passage that a third of all texts share strains no task.
    """
    scan = stored(_scan(docs, spec), f"{folder}/scan")
    classes = scan.where(F.col("n") >= spec.window).groupBy("digest")
    classes = classes.agg(F.min(F.struct("doc_id", "uid")).alias("first"), F.count("*").alias("c"))
    several = stored(classes.where("c > 1").select("digest", "first.uid"), f"{folder}/classes")
    copies = scan.select("digest", F.col("uid").alias("own"), "n").join(several, "digest")
    copies = copies.where((F.col("own") != F.col("uid")) & (F.col("n") >= spec.window))
    copies = stored(copies.select(F.col("own").alias("uid")), f"{folder}/copies")
    anchors = scan.join(copies, "uid", "left_anti").select(
        "uid", F.explode(F.arrays_zip("grams", "places")).alias("a")
    )
    anchors = anchors.select("uid", F.col("a.grams").alias("gram"), F.col("a.places").alias("place"))
    twice = anchors.groupBy("gram").count().where("count > 1").select("gram")
    twice = stored(twice, f"{folder}/twice")
    marked = anchors.join(twice, "gram", "left_semi").groupBy("uid")
    marks = stored(marked.agg(F.collect_list("place").alias("marks")), f"{folder}/marks")
    contexts = _contexts(docs.join(marks, "uid"), spec)
    order = F.struct("doc_id", "uid", "start")
    distinct = contexts.groupBy("key", "lead", "content", "windows").agg(
        F.min(order).alias("first"), F.count("*").alias("n")
    )
    distinct = stored(distinct, f"{folder}/contexts")
    owned = owners(distinct, spec).groupBy("uid").agg(
        F.collect_list(F.struct("start", "windows")).alias("owned")
    )
    owned = stored(owned, f"{folder}/owned")
    none = F.lit(None)
    kind = "array<struct<start:long,windows:int>>"
    parts = marks.select("uid", "marks", none.cast(kind).alias("owned"), F.lit(False).alias("copy"))
    parts = parts.unionByName(
        owned.select("uid", none.cast("array<int>").alias("marks"), F.col("owned").cast(kind), F.lit(False).alias("copy"))
    )
    parts = parts.unionByName(
        copies.select("uid", none.cast("array<int>").alias("marks"), none.cast(kind).alias("owned"), F.lit(True).alias("copy"))
    )
    # a text has one list of each at most
    whole = parts.groupBy("uid").agg(
        F.first("marks", True).alias("marks"),
        F.first("owned", True).alias("owned"),
        F.max("copy").alias("copy"),
    )
    return stored(whole, f"{folder}/repeats")


def removals(own: Texts, part: pa.RecordBatch) -> np.ndarray:
    """Flags of the units that a repeated window covers, later copies whole.

    Only texts with marks are hashed again.
    """
    marks, owned = part.column("marks").to_pylist(), part.column("owned").to_pylist()
    removed = np.zeros(int(own.length.sum()), bool)
    some = [i for i, m in enumerate(marks) if m is not None]
    if some:
        sub = Texts(own.spec, [own.parts[i] for i in some])
        first = np.zeros(len(sub.grams) + 1, bool)
        first[sub.candidates(sub.mark([marks[i] for i in some]))[0]] = True
        for start, i in zip(sub.start.tolist(), some, strict=True):
            for r in owned[i] or ():
                first[start + r["start"] : start + r["start"] + r["windows"]] = False
        at = np.flatnonzero(first)
        edge = np.zeros(len(sub.grams) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + own.spec.window, -1)
        cover = np.cumsum(edge) > 0
        for start, i in zip(sub.start.tolist(), some, strict=True):
            length = own.length[i]
            removed[own.start[i] : own.start[i] + length] = cover[start : start + length]
    for i in np.flatnonzero(part.column("copy").fill_null(False).to_numpy(zero_copy_only=False)):
        removed[own.start[i] : own.start[i] + own.length[i]] = True
    return removed


def judged(docs: DataFrame, repeats: DataFrame, spec: Spec, schema: str, judge) -> DataFrame:
    """One row per text: `judge(texts, removed flags)` gives its columns beside doc_id.

    The one shuffle of texts beside the one for contexts.
    """
    rows = docs.join(repeats, "uid", "left")

    def run(batches) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]
        for batch in batches:
            for part, texts in pieces(batch, "text", _SLICE):
                own = Texts.of(spec, texts)
                columns = judge(own, removals(own, part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    return rows.mapInArrow(run, f"doc_id long, {schema}")
