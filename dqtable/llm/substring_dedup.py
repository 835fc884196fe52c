"""Repeated passages of words, by level-wise doubling.

Level one: windows of five words (one per window of twenty, chosen by content). Only those that
repeat are extended to ten words, only runs around repeated windows of ten to twenty. A window of
twenty words that starts earlier elsewhere too is removed; the first one stays.

Rows: one per row of `docs`. A null text has no words. The order is by doc_id, null first; rows that
share a doc_id come in the order in which they are read. Texts of fewer than twenty words stay
whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import work_folder
from dqtable.llm.windows import Spec, Texts, judged, numbered, repeated

#: Words per window, and per window of the first level.
WINDOW, LEVEL = 20, 5


def first_windows(contexts: DataFrame, spec: Spec) -> DataFrame:
    """(uid, start, windows): where each distinct window of 20 words starts first.

    Contexts whose ten words occur once are not extended: all their windows are their own.
    """
    alive = contexts.groupBy("key").agg(F.sum("n").alias("c")).where("c > 1").select("key")
    rows = contexts.join(alive.withColumn("alive", F.lit(True)), "key", "left")
    rows = rows.select("content", "windows", "first.*", F.coalesce("alive", F.lit(False)).alias("alive"))

    def run(batches):
        for batch in batches:
            out = []
            for content, windows, doc, uid, start, alive in zip(
                *(batch.column(c).to_pylist() for c in ("content", "windows", "doc_id", "uid", "start", "alive")),
                strict=True,
            ):
                if not alive:
                    out.append((None, windows, doc, uid, start))
                    continue
                words = content.split(b" ")
                for i in range(windows):
                    digest = xxhash.xxh3_128_digest(b" ".join(words[i : i + spec.window]))
                    out.append((digest, 1, doc, uid, start + i))
            kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [list(c) for c in zip(*out, strict=True)] or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["digest", "windows", "doc_id", "uid", "start"],
            )

    found = rows.mapInArrow(run, "digest binary, windows int, doc_id long, uid long, start long")
    alone = found.where("digest is null").select("uid", "start", "windows")
    first = F.min(F.struct("doc_id", "uid", "start")).alias("f")
    extended = found.where("digest is not null").groupBy("digest").agg(first)
    extended = extended.select("f.uid", "f.start", F.lit(1).alias("windows"))
    return alone.unionByName(extended)


def without_repeats(
    docs: DataFrame, window: int = WINDOW, level: int = LEVEL, texts: bool = True
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256 and, unless told otherwise, kept_text) per row."""
    spec = Spec("word", window, level)
    rows = numbered(docs)
    found = repeated(rows, spec, first_windows, work_folder(docs.sparkSession, "substrings"))

    def judge(own: Texts, removed):
        kept = []
        for start, length in zip(own.start.tolist(), own.length.tolist(), strict=True):
            gone = removed[start : start + length]
            words = own.words[start : start + length]
            if gone.any():
                words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
            kept.append((length, length - len(words), b" ".join(words)))
        return [
            pa.array([k[0] for k in kept], pa.int64()),
            pa.array([k[1] for k in kept], pa.int64()),
            pa.array([hashlib.sha256(k[2]).hexdigest() for k in kept], pa.string()),
            *[pa.array([k[2] for k in kept], pa.binary()).cast(pa.string())] * texts,
        ]

    schema = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return judged(rows, found, spec, schema, judge)
