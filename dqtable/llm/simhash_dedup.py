"""SimHash near-duplicates: fingerprints, a binary trie joined with itself, components.

Rows: one per row of `docs`. A null text is an empty one; texts without words have fingerprint zero
and link like any other. A null doc_id takes part, but never names a component unless its whole
component has none (then null). Repeated rows share a component. Other columns are ignored, or kept
whole by `drop_near_duplicates`.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import arrays, fill, pieces, stored, work_folder
from dqtable.llm.components import components

BITS = 64
#: Distinct fingerprints below one node where the distributed traversal starts.
NODE_SIZE = 1 << 14
#: Levels that may be walked before the work is dealt out.
MAX_TOP = 16
#: Node pairs that are expanded at once.
FRONTIER = 1 << 21
_BLOCK = 1 << 16
_ONE = "__digest_of_text"


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a text over word shingles, repeats included (majority of XXH64 bits)."""
    words = text.lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, _BLOCK):
        stop = min(start + _BLOCK, count)
        hashes = np.fromiter(
            (
                xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42)
                for i in range(start, stop)
            ),
            dtype=">u8",
            count=stop - start,
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, digest, fp): a digest of the text, and its fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                fps = [fingerprint(t, shingle) for t in texts]
                yield arrays(part, ["doc_id", "digest"], schema, fp=fps)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), fill().alias("text")
    )
    return source.mapInArrow(run, "doc_id long, digest long, fp long")


def _digest():
    """Tells texts of rows with one doc_id apart."""
    return F.xxhash64(fill())


class Trie:
    """A binary trie over sorted distinct values, as arrays per level.

    `first[k]` holds the position of each node's first value, `size[k]` the number of its values,
    `child[k]` its two children on the next level (-1: none).
    """

    def __init__(self, values: np.ndarray, top: int):
        self.values = values
        self.first, self.size, self.child = {}, {}, {}
        for level in range(top, BITS + 1):
            prefix = values >> np.uint64(BITS - level) if level else np.zeros_like(values)
            cut = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            self.first[level] = cut
            self.size[level] = np.diff(np.r_[cut, len(values)])
            if level > top:
                self.child[level - 1] = self._children(level, cut)

    def _children(self, level: int, cut: np.ndarray) -> np.ndarray:
        parents = np.searchsorted(self.first[level - 1], cut, "right") - 1
        bit = (self.values[cut] >> np.uint64(BITS - level)) & np.uint64(1)
        child = np.full((2, len(self.first[level - 1])), -1, np.int32)
        child[bit.astype(np.int8), parents] = np.arange(len(cut))
        return child


class Links:
    """Joins positions into groups and returns one link per position that is not a group's first."""

    def __init__(self, count: int):
        self.label = np.arange(count)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            open_ = a != b
            i, j = i[open_], j[open_]
            low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(self.label, high, low)
            while not np.array_equal(hop := self.label[self.label], self.label):
                self.label = hop

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero(self.label != np.arange(len(self.label)))
        return own, self.label[own]


def join_tries(left: np.ndarray, right: np.ndarray | None, top: int, budget: int):
    """Links between values at most `budget` bits apart, as (value, value of its group).

    Pairs of nodes descend together. A pair carries the bits that differ so far and is dropped once
    they exceed the budget; two single values are compared at once. `right` None joins `left` with
    itself. The top bits are those that all values of a side share; a pair of sides that differ
    there starts with those bits counted (`budget` is what remains).
    """
    a_trie = Trie(left, top)
    b_trie = a_trie if right is None else Trie(right, top)
    offset = 0 if right is None else len(left)
    links = Links(offset + len(b_trie.values))
    low = np.uint64((1 << (BITS - top)) - 1)  # the top bits are counted by the caller
    zero = np.zeros(1, np.int32)
    stack = [(top, zero, zero, np.zeros(1, np.int8))]
    while stack:
        level, a, b, far = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(level, x[0], x[1], x[2]) for x in ((a[:half], b[:half], far[:half]),)]
            stack += [(level, a[half:], b[half:], far[half:])]
            continue
        single = (a_trie.size[level][a] == 1) & (b_trie.size[level][b] == 1)
        i, j = a_trie.first[level][a[single]], b_trie.first[level][b[single]]
        near = np.bitwise_count((a_trie.values[i] ^ b_trie.values[j]) & low) <= budget
        links.add(i[near], j[near] + offset)
        a, b, far = a[~single], b[~single], far[~single]
        if not len(a) or level == BITS:
            continue
        (a0, a1), (b0, b1) = a_trie.child[level][:, a], b_trie.child[level][:, b]
        mirrored = (a == b) if right is None else np.zeros(len(a), bool)
        found = []
        for x, y, more, skip in (
            (a0, b0, 0, None),
            (a1, b1, 0, None),
            (a0, b1, 1, None),
            (a1, b0, 1, mirrored),
        ):
            keep = (x >= 0) & (y >= 0) & (far + more <= budget)
            if skip is not None:
                keep &= ~skip
            found.append((x[keep], y[keep], far[keep] + np.int8(more)))
        stack.append((level + 1, *(np.concatenate(c) for c in zip(*found, strict=True))))
    values = a_trie.values if right is None else np.concatenate([left, right])
    own, root = links.stars()
    return values[own], values[root]


def _masks(top: int, budget: int) -> list[int]:
    """The differences that two nodes `top` bits deep may have."""
    return [sum(1 << b for b in c) for k in range(budget + 1) for c in combinations(range(top), k)]


def fingerprint_links(distinct: DataFrame, budget: int) -> DataFrame:
    """(a, b): links that connect all fingerprints at most `budget` bits apart.

    `distinct` (fp) is a stored table without repeats. The first levels of the traversal are walked
    as a join key: every node goes to the pairs it may form with nodes that differ in at most
    `budget` of the top bits, and each pair of nodes is one group. The depth follows the number of
    fingerprints, so that a group stays small at any size. A group returns a spanning forest instead
    of its pairs, which keeps dense clusters linear.
    """
    count = distinct.count()
    top = min(MAX_TOP, max(4, (count // NODE_SIZE).bit_length()))
    masks = F.array(*[F.lit(m).cast("int") for m in _masks(top, budget)])
    node = F.shiftrightunsigned("fp", BITS - top).cast("int")
    dealt = distinct.select("fp", node.alias("n"), F.explode(masks).alias("mask")).select(
        "fp",
        "mask",
        F.least("n", F.col("n").bitwiseXOR(F.col("mask"))).alias("pair"),
        (F.col("n") > F.col("n").bitwiseXOR(F.col("mask"))).alias("high"),
    )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(rows.loc[~rows["high"], "fp"].to_numpy().view(np.uint64))
        mask = int(rows["mask"].iloc[0])
        if mask == 0:
            a, b = join_tries(fps, None, top, budget)
        else:
            other = np.sort(rows.loc[rows["high"], "fp"].to_numpy().view(np.uint64))
            if not len(fps) or not len(other):
                return pd.DataFrame({"a": [], "b": []}, dtype="int64")
            a, b = join_tries(fps, other, top, budget - mask.bit_count())
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("pair", "mask").applyInPandas(join, "a long, b long")


def _groups(docs: DataFrame, shingle: int, max_bits: int, folder: str):
    """(doc_id, digest, fp) of every row; (fp, group, component_id) of fingerprints with company."""
    prints = stored(fingerprints(docs, shingle), f"{folder}/prints")
    classes = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")),
        f"{folder}/classes",
    )
    links = fingerprint_links(classes.select("fp"), max_bits)
    roots = components(links, folder).withColumnRenamed("node", "fp")
    group = classes.join(roots, "fp", "left").withColumn("group", F.coalesce("root", "fp"))
    least = group.groupBy("group").agg(
        F.min("least").alias("component_id"), F.sum("n").alias("members")
    )
    several = group.select("fp", "group").join(least.where("members > 1"), "group")
    return prints, stored(several.select("fp", "group", "component_id"), f"{folder}/several")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    The text is read once and never shuffled. Copies of a fingerprint are merged in the map tasks
    before the self-join; only fingerprints with copies or links enter the last join.
    """
    folder = work_folder(docs.sparkSession, "simhash")
    prints, several = _groups(docs, shingle, max_bits, folder)
    return prints.join(several.drop("group"), "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component_id").isNotNull(), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of `docs` per component, all columns kept: the smallest doc_id, any over none.

    Rows of one doc_id in a component are told apart by a digest of their texts; equal rows leave
    one. What is joined with the texts is the table of rows that go.
    """
    folder = work_folder(docs.sparkSession, "simhash-kept")
    prints, several = _groups(docs, shingle, max_bits, folder)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    rows = prints.join(several, "fp").groupBy("group", "doc_id", "digest")
    rows = stored(rows.agg(F.count("*").alias("n")), f"{folder}/rows")
    best = rows.groupBy("group").agg(F.min(order).alias("best"))
    marked = rows.join(best, "group").select(
        "doc_id", "digest", "n", (order == F.col("best")).alias("stays")
    )
    # rows that go, and rows that stay once though they occur several times
    marked = stored(marked.where("not stays or n > 1"), f"{folder}/marked")

    def meets(other):
        return F.col("doc_id").cast("long").eqNullSafe(other["id"]) & (_digest() == other["digest"])

    named = marked.withColumnRenamed("doc_id", "id")
    kept = docs.join(named, meets(named), "left_anti")
    again = named.where("stays")
    if again.isEmpty():
        return kept
    once = docs.join(again, meets(again), "left_semi").withColumns({_ONE: _digest()})
    return kept.unionByName(once.dropDuplicates(["doc_id", _ONE]).drop(_ONE))
