"""Hard negatives: rows of another label that score just below an anchor's positives.

Vectors are whole numbers, so scores are exact. Each vector is stored with the mean and deviation of
its segments, for segments of several lengths. The inner product of two segments is the product of
their means, times their length, plus or minus at most the product of their deviations. Summed over
segments this bounds a score from both sides: first with the whole vector as one segment, then with
shorter and shorter ones for what remains, and only what still may count is scored exactly.

Rows with a null label, a null vector or a null or non-finite component take no part. A null id is
no anchor, and comes last among equal scores. Rows that repeat an id or a whole row count as rows of
their own; an anchor is no partner of itself. Shorter vectors are filled up with zeros. Components
beyond 2^19 either way count as that, which keeps scores within 64 bits for up to 512 dimensions.
Other columns are ignored. An empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqtable.llm.common import stored, work_folder

SCALE = 256
#: Largest component after scaling.
LARGEST = 1 << 27
#: Segments of a vector per level, from the whole vector on.
LEVELS = (1, 4, 16)
#: Anchors that one pass over the rows serves, and bytes of their vectors.
BLOCK_ANCHORS, BLOCK_BYTES = 4096, 1 << 23
#: Scores that a task holds at once.
CELLS = 1 << 21
#: Candidates of a task before all but the best are dropped.
HELD = 1 << 18
_EXACT = 2.0**53


def _segments(dims: int, count: int) -> np.ndarray:
    """First places of up to `count` segments of nearly equal length."""
    return np.unique(np.arange(count) * dims // count)


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Per row, for every level: sum / sqrt(length) of each segment, then its deviation's norm.

    The product of two such sums is the length times the product of the means.
    """
    out = []
    for count in LEVELS:
        first = _segments(vectors.shape[1], count)
        length = np.diff(np.r_[first, vectors.shape[1]])
        total = np.add.reduceat(vectors, first, axis=1)
        square = np.add.reduceat(vectors * vectors, first, axis=1)
        spread = np.sqrt(np.maximum(square - total * total / length, 0))
        out += [total / np.sqrt(length), spread]
    return np.concatenate(out, axis=1)


def _levels(dims: int) -> list[tuple[slice, slice]]:
    """Where each level's means and deviations lie in the summaries."""
    out, at = [], 0
    for count in LEVELS:
        n = len(_segments(dims, count))
        out.append((slice(at, at + n), slice(at + n, at + 2 * n)))
        at += 2 * n
    return out


def vectors_of(embeddings: DataFrame, every: int, labels: int, folder: str) -> tuple[DataFrame, int]:
    """(uid, vec_id, label, vec, summary) of the rows that take part, written; and the dimensions.

    Labels of rows whose id is divisible by `every` are one off, modulo `labels`.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    moved = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    label = F.col("label").cast("long")
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(moved, (label + 1) % labels).otherwise(label).alias("label"),
        x.alias("x"),
    )
    dims = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 1)
    names = ["uid", "vec_id", "label", "vec", "summary"]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, max(1, CELLS // dims)):
                part = batch.slice(start, max(1, CELLS // dims))
                lists = part.column("x")
                whole = np.zeros((len(lists), dims))
                size = np.diff(lists.offsets.to_numpy())
                inside = np.arange(dims) < size[:, None]
                whole[inside] = lists.flatten().to_numpy(zero_copy_only=False)
                whole = np.clip(np.floor(whole * SCALE), -LARGEST, LARGEST)
                packed = [
                    [row.tobytes() for row in whole.astype(np.int32)],
                    [row.tobytes() for row in summaries(whole).astype(np.float32)],
                ]
                columns = [part.column(c) for c in names[:3]]
                columns += [pa.array(p, pa.binary()) for p in packed]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "uid long, vec_id long, label long, vec binary, summary binary"
    return stored(rows.mapInArrow(run, schema), f"{folder}/vectors"), dims


class Best:
    """The best candidates per slot: higher scores first, then smaller ids, null ids last."""

    def __init__(self, slots: int, top: int):
        self.top, self.least = top, np.full(slots, np.iinfo(np.int64).min)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, slot, score, vec_id, null) -> None:
        self.parts.append((slot, score, vec_id, null))
        self.held += len(slot)
        if self.held > HELD:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Keep the best; from then on a slot that is full takes nothing below its last."""
        empty = np.zeros(0, np.int64)
        parts = self.parts or [(empty, empty, empty, empty.astype(bool))]
        slot, score, vec_id, null = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((vec_id, null, -score, slot))
        slot, score, vec_id, null = slot[order], score[order], vec_id[order], null[order]
        first = np.searchsorted(slot, slot, "left")
        rank = np.arange(len(slot)) - first
        last = rank == self.top - 1
        self.least[slot[last]] = score[last]
        keep = rank < self.top
        kept = slot[keep], score[keep], vec_id[keep], null[keep]
        self.parts, self.held = [kept], int(keep.sum())
        return kept


class Anchors:
    """A block of anchors with the windows that their partners' scores must lie in."""

    def __init__(self, uid, label, vec, summary, low, high, same: bool, top: int):
        self.uid, self.label, self.same, self.top = uid, label, same, top
        self.vec, self.summary = vec, summary
        #: anchors x windows; a window with low > high takes nothing
        self.low, self.high = low, high

    def search(self, batches, dims: int):
        """The best rows of all batches per window, as arrays (slot, score, id, id is null)."""
        best = Best(self.low.size, self.top)
        for batch in batches:
            step = max(1, min(CELLS // max(1, len(self.uid)), CELLS // dims))
            for start in range(0, batch.num_rows, step):
                self._rows(batch.slice(start, step), dims, best)
        return best.settle()

    def _rows(self, part: pa.RecordBatch, dims: int, best: Best) -> None:
        rows = part.num_rows
        uid, label = (part.column(c).to_numpy() for c in ("uid", "label"))
        vec_id = part.column("vec_id")
        null = vec_id.is_null().to_numpy(zero_copy_only=False)
        vec_id = vec_id.fill_null(0).to_numpy()
        vec = np.frombuffer(b"".join(part.column("vec").to_pylist()), np.int32).reshape(rows, dims)
        summary = np.frombuffer(b"".join(part.column("summary").to_pylist()), np.float32)
        summary = summary.reshape(rows, -1)
        floor = np.maximum(self.low, best.least.reshape(self.low.shape))
        floor = np.where(self.low <= self.high, floor, np.iinfo(np.int64).max)
        need, most = floor.min(axis=1).astype(float), self.high.max(axis=1).astype(float)
        fits = (self.label[:, None] == label) == self.same
        fits &= self.uid[:, None] != uid
        a, r = self._refined(summary, fits, need, most, dims)
        if not len(a):
            return
        score = self._scores(a, vec[r])
        for k in range(self.low.shape[1]):
            good = fits[np.ix_(a, r)] & (score >= floor[a, k, None]) & (score <= self.high[a, k, None])
            i, j = np.nonzero(good)
            best.add(a[i] * self.low.shape[1] + k, score[i, j], vec_id[r[j]], null[r[j]])

    def _refined(self, summary, fits, need, most, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """The anchors and rows that bounds cannot part, level by level."""
        a, r = np.arange(len(self.uid)), np.arange(len(summary))
        for means, spreads in _levels(dims):
            x, y = self.summary[a].astype(float), summary[r].astype(float)
            middle = x[:, means] @ y[:, means].T
            width = x[:, spreads] @ y[:, spreads].T
            # summaries are rounded to 24 bits: each term may be off by a few parts in 2^24
            size = np.abs(x[:, means]) @ np.abs(y[:, means]).T + width
            width += size * 2.0**-20 + 2.0**-10
            open_ = fits[np.ix_(a, r)]
            open_ &= (middle + width >= need[a, None]) & (middle - width <= most[a, None])
            a, r = a[open_.any(axis=1)], r[open_.any(axis=0)]
            if not len(a):
                break
        return a, r

    def _scores(self, a: np.ndarray, vec: np.ndarray) -> np.ndarray:
        x, y = self.vec[a].astype(float), vec.astype(float)
        if x.shape[1] * np.abs(x).max(initial=0) * np.abs(y).max(initial=0) < _EXACT:
            return (x @ y.T).astype(np.int64)
        return self.vec[a].astype(np.int64) @ vec.astype(np.int64).T


def _matches(vectors: DataFrame, anchors: Anchors, dims: int) -> DataFrame:
    """(anchor, window, score, vec_id): the best of all rows per window of the block."""
    sent = vectors.sparkSession.sparkContext.broadcast(vars(anchors))
    names = ["anchor", "window", "score", "vec_id"]

    def run(batches):
        own = Anchors.__new__(Anchors)
        own.__dict__.update(sent.value)
        slot, score, vec_id, null = own.search(batches, dims)
        columns = [
            pa.array(own.uid[slot // own.low.shape[1]]),
            pa.array((slot % own.low.shape[1]).astype(np.int32)),
            pa.array(score),
            pa.array(vec_id, mask=null),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    found = vectors.mapInArrow(run, "anchor long, window int, score long, vec_id long")
    order = F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= anchors.top)


def _blocks(anchors: DataFrame, size: int):
    """The anchors, `size` at a time, in the order of their uids."""
    last = -1
    while rows := anchors.where(F.col("uid") > last).orderBy("uid").limit(size).collect():
        yield rows
        last = rows[-1].uid


def hard_negatives(
    embeddings: DataFrame,
    *,
    anchor_every: int = 100,
    relabel_every: int = 7,
    labels: int = 10,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors go out in blocks of bounded size, two passes over the rows each: first for the positives,
    then, with windows that follow from their scores, for the negatives. A task returns no more than
    the best of each window; rows are not shuffled.
    """
    folder = work_folder(embeddings.sparkSession, "negatives")
    vectors, dims = vectors_of(embeddings, relabel_every, labels, folder)
    anchors = stored(vectors.where(F.col("vec_id") % anchor_every == 0), f"{folder}/anchors")
    names = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    size = max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // (4 * dims)))
    paths: list[str] = []
    for number, rows in enumerate(_blocks(anchors, size)):
        here = f"{folder}/block-{number}"
        uid = np.array([r.uid for r in rows], np.int64)
        of = {
            "uid": uid,
            "label": np.array([r.label for r in rows], np.int64),
            "vec": np.frombuffer(b"".join(r.vec for r in rows), np.int32).reshape(len(rows), -1),
            "summary": np.frombuffer(b"".join(r.summary for r in rows), np.float32).reshape(len(rows), -1),
        }
        limits = np.iinfo(np.int64)
        low, high = np.full((len(rows), 1), limits.min), np.full((len(rows), 1), limits.max)
        near = _matches(vectors, Anchors(**of, low=low, high=high, same=True, top=positives), dims)
        near = stored(near.withColumn("window", F.col("rank") - 1), f"{here}/positives")
        low = np.full((len(rows), positives), limits.max)
        high = np.full((len(rows), positives), limits.min)
        for r in near.select("anchor", "window", "score").collect():
            at = int(np.searchsorted(uid, r.anchor)), r.window
            low[at], high[at] = -(-low_percent * r.score // 100), high_percent * r.score // 100
        far = _matches(vectors, Anchors(**of, low=low, high=high, same=False, top=negatives), dims)
        far = far.withColumnsRenamed({"score": "negative_score", "vec_id": "negative_id"})
        near = near.select(
            "anchor", "window", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")
        )
        columns = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        paths.append(f"{here}/negatives")
        schema = stored(far.join(near, ["anchor", "window"]).select(*columns), paths[-1]).schema
    if not paths:
        empty = "anchor_id long, positive_id long, rank int, negative_id long"
        empty += ", positive_score long, negative_score long"
        return embeddings.sparkSession.createDataFrame([], empty)
    found = embeddings.sparkSession.read.schema(schema).parquet(*paths)
    return found.join(names, "anchor").select("anchor_id", *columns[1:])
