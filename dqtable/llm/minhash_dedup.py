"""MinHash near-duplicates: universal hash minima in bands, verified on whole shingle sets.

Texts with the same set of shingles are one class. Of each class, the minima of BANDS * ROWS
universal hash functions are cut into bands; classes that agree in a band meet. Two sets of
similarity s miss all bands but one with probability (1 - s^5)^40 + 40 s^5 (1 - s^5)^39: 2e-9 at 0.85.
What meets is compared by its signatures, then on the full sets; only that makes a link. Connected
components come from alternating large and small stars.

Rows: one per row of `docs`. Null texts and texts without words have an empty set and link with
nothing; a text with fewer words than a shingle is one shingle. A null doc_id takes part, but names a
component only where no row of it has an id (then null). Repeated rows share a component. Texts are
read whole, however long. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import fill, pieces, stored, work_folder
from dqtable.llm.components import components

ROWS, BANDS = 5, 40
MINIMA = ROWS * BANDS
#: Chance that a signature of a pair at the threshold is taken for that of a less similar pair.
MISSED = 1e-9
#: Members of a bucket that lists its pairs: up to seven and a half per member.
SMALL = 16
#: Members of larger buckets that one task compares with as many others.
BLOCK = 1024
#: Star rounds go on while they link one in so many of the members of buckets still open.
WORTHWHILE = 50
_STEP = 128  # shingles hashed at once
_MASK = (1 << 64) - 1
_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_A = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2)
_MIX = _RANDOM.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(32))) * _MIX[6]
    x = (x ^ (x >> np.uint64(29))) * _MIX[7]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """Per text its distinct shingles, as sorted 64-bit hashes of word sequences."""
    lists = [t.lower().split() for t in texts]
    index: dict[bytes, int] = {}
    ids = [np.array([index.setdefault(w, len(index)) for w in words], np.int64) for words in lists]
    words = np.fromiter((xxhash.xxh64_intdigest(w, 12) for w in index), np.uint64, len(index))
    out = []
    for own in ids:
        known = words[own]
        count = max(1, len(own) - shingle + 1) if len(own) else 0
        total = np.zeros(count, np.uint64)
        for k in range(min(shingle, len(own))):
            # places in a shingle have different factors: the order of words counts
            factor = np.uint64(pow(int(_MIX[0]), k + 1, 1 << 64))
            total += _mixed(known[k : k + count] * factor)
        total += np.uint64(min(shingle, len(own)))  # a short text is no part of a longer shingle
        out.append(np.unique(_mixed(total)))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of a set under (a x + b) >> 32, x the upper half of a shingle's hash."""
    least = np.full(MINIMA, _MASK, np.uint64)
    upper = shingles >> np.uint64(32)
    for start in range(0, len(upper), _STEP):
        part = upper[start : start + _STEP]
        values = _A[:, None] * part[None, :]
        values += _B[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least >> np.uint64(32)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One key per band, of its number and its minima."""
    rows = minima.reshape(BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64) * _MIX[5]
    for k in range(ROWS):
        total += _mixed(rows[:, k] * _MIX[k])
    return _mixed(total).view(np.int64)


def least_agreement(percent: int) -> int:
    """Minima that two sets of the threshold's similarity share, but for a chance of MISSED."""
    s, below = percent / 100, 0.0
    for shared in range(MINIMA + 1):
        below += comb(MINIMA, shared) * s**shared * (1 - s) ** (MINIMA - shared)
        if below > MISSED:
            return shared
    return MINIMA


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(uid, doc_id, n, d1, d2, bands, sketch) per row: the set's size and digest, band keys, and
    eight bits of each minimum. `uid` numbers the rows as they are scanned."""
    names = ["uid", "doc_id", "n", "d1", "d2", "bands", "sketch"]

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                sets = shingle_sets(texts, shingle)
                digests = np.frombuffer(
                    b"".join(xxhash.xxh3_128_digest(s.tobytes(), 7) for s in sets), np.int64
                ).reshape(-1, 2)
                minima = [signature(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"),
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.array(
                            [None if m is None else band_keys(m) for m in minima],
                            pa.list_(pa.int64()),
                        ),
                        pa.array(
                            [None if m is None else m.astype(np.uint8).tobytes() for m in minima],
                            pa.binary(),
                        ),
                    ],
                    names=names,
                )

    schema = "uid long, doc_id long, n long, d1 long, d2 long, bands array<long>, sketch binary"
    return _numbered(docs).mapInArrow(run, schema)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        fill().alias("text"),
    )


def _alike_sizes(n: str, m: str, percent: int):
    """Sets whose sizes differ by more cannot be that similar."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


class Sets:
    """The sets behind class numbers, made again from the texts where they are needed."""

    def __init__(self, docs: DataFrame, reps: DataFrame, shingle: int, percent: int, folder: str):
        self.docs, self.shingle, self.percent = _numbered(docs).drop("doc_id"), shingle, percent
        self.sketches, self.folder, self.calls = reps.select("uid", "sketch"), folder, 0

    def of(self, uids: DataFrame) -> DataFrame:
        """(uid, shingles) of the given uids."""
        shingle = self.shingle

        def run(batches):
            for batch in batches:
                for part, texts in pieces(batch, "text"):
                    sets = [s.view(np.int64) for s in shingle_sets(texts, shingle)]
                    columns = [part.column("uid"), pa.array(sets, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["uid", "shingles"])

        wanted = self.docs.join(uids, "uid", "left_semi").select("uid", "text")
        return wanted.mapInArrow(run, "uid long, shingles array<long>")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links: signatures first, then whole sets. Written."""
        self.calls += 1
        folder = f"{self.folder}/verify-{self.calls}"
        least = least_agreement(self.percent)

        def agreeing(batches):
            for batch in batches:
                a, b = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA)
                    for c in ("sketch_a", "sketch_b")
                )
                keep = pa.array((a == b).sum(axis=1) >= least)
                yield batch.select(["a", "b"]).filter(keep)

        both = pairs
        for side in "ab":
            own = self.sketches.select(
                F.col("uid").alias(side), F.col("sketch").alias(f"sketch_{side}")
            )
            both = both.join(own, side)
        both = both.select("a", "b", "sketch_a", "sketch_b").mapInArrow(agreeing, "a long, b long")
        both = stored(both, f"{folder}/agree")
        uids = both.select(F.col("a").alias("uid")).unionAll(both.select("b")).distinct()
        sets = stored(self.of(stored(uids, f"{folder}/uids")), f"{folder}/sets")
        shared = both
        for side in "ab":
            own = sets.select(F.col("uid").alias(side), F.col("shingles").alias(f"set_{side}"))
            shared = shared.join(own, side)
        inside = F.size(F.array_intersect("set_a", "set_b")).cast("long")
        union = F.size("set_a") + F.size("set_b") - inside
        links = shared.where(100 * inside >= self.percent * union).select("a", "b")
        return stored(links, f"{folder}/links")


def _small_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs in buckets of at most SMALL members that meet twice at least."""
    few = members.where(F.col("members") <= SMALL)
    a = few.select("key", F.col("uid").alias("a"), F.col("n").alias("n_a"))
    b = few.select("key", F.col("uid").alias("b"), F.col("n").alias("n_b"))
    met = a.join(b, "key").where((F.col("a") < F.col("b")) & _alike_sizes("n_a", "n_b", percent))
    return met.groupBy("a", "b").agg(F.count("*").alias("k")).where("k > 1").select("a", "b")


def _stars(members: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each member with one of its bucket, another one every turn, unless they are linked."""
    order = F.struct(F.xxhash64("uid", F.lit(turn)).alias("h"), "uid", "n", "group")
    lead = members.groupBy("key").agg(F.min(order).alias("lead"))
    pairs = members.join(lead, "key").where("group <> lead.group")
    pairs = pairs.withColumn("n_b", F.col("lead.n")).where(_alike_sizes("n", "n_b", percent))
    ends = F.least("uid", "lead.uid").alias("a"), F.greatest("uid", "lead.uid").alias("b")
    return pairs.select(*ends).distinct()


def _grouped(members: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """Members with the group that the links so far put them in; buckets of one group are done."""
    roots = components(links, f"{folder}/components").withColumnRenamed("node", "uid")
    rows = members.drop("group").join(roots, "uid", "left")
    rows = rows.withColumn("group", F.coalesce("root", "uid")).drop("root")
    rows = stored(rows, f"{folder}/grouped")
    several = rows.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    several = several.where("low <> high").select("key")
    return stored(rows.join(several, "key"), f"{folder}/open")


def _dealt(members: DataFrame) -> DataFrame:
    """The members of open buckets in pairs of blocks (key, p, q), so that any two of different
    groups meet in one of them.

    The largest group of a bucket goes in blocks of its own: its members are not compared with each
    other, so a bucket with one stranger is cheap however large it is.
    """
    groups = members.groupBy("key", "group").agg(F.count("*").alias("rows"))
    most = F.max(F.struct("rows", "group"))
    sizes = groups.groupBy("key").agg(F.sum("rows").alias("all"), most.alias("most"))
    rows = members.join(sizes, "key").withColumn("rest", F.col("group") != F.col("most.group"))

    def blocks(n):
        return F.ceil(n / F.lit(BLOCK)).cast("int")

    one = F.col("all") <= BLOCK
    rows = rows.withColumn("nr", F.when(one, 1).otherwise(blocks(F.col("all") - F.col("most.rows"))))
    rows = rows.withColumn("nm", F.when(one, 0).otherwise(blocks(F.col("most.rows"))))
    side = F.when(one | F.col("rest"), F.col("nr")).otherwise(F.col("nm"))
    rows = rows.withColumn("at", F.pmod(F.xxhash64("uid"), side).cast("int"))
    rows = rows.withColumn("at", F.when(one | F.col("rest"), F.col("at")).otherwise(F.col("nr") + F.col("at")))
    others = F.sequence(F.lit(0), F.when(F.col("at") < F.col("nr"), F.col("nr") + F.col("nm") - 1).otherwise(F.col("nr") - 1))
    rows = rows.withColumn("other", F.explode(others))
    ends = F.least("at", "other").alias("p"), F.greatest("at", "other").alias("q")
    return rows.select("key", *ends, "at", "uid", "group", "n")


def _near_in_block(frame: pd.DataFrame, percent: int, least: int):
    """(i, js) of rows in different groups whose sizes and signatures agree, for two blocks."""
    sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, MINIMA)
    n, group = frame["n"].to_numpy(), frame["group"].to_numpy()
    at, p, q = frame["at"].to_numpy(), frame["p"].iloc[0], frame["q"].iloc[0]
    left, right = np.flatnonzero(at == p), np.flatnonzero(at == q)
    for i in left.tolist():
        js = right[right > i] if p == q else right
        small, large = np.minimum(n[i], n[js]), np.maximum(n[i], n[js])
        js = js[(group[js] != group[i]) & (100 * small >= percent * large)]
        js = js[(sketch[js] == sketch[i]).sum(axis=1) >= least]
        if len(js):
            yield i, js


def _block_links(members: DataFrame, sets: Sets, folder: str) -> DataFrame:
    """Links between different groups of the open buckets.

    Signatures come first; only members that agree with one of another group take their sets to a
    second round. It returns links that join groups not yet joined in its blocks, and compares a pair
    in the first bucket that it shares.
    """
    percent, least = sets.percent, least_agreement(sets.percent)

    def suspects(frame: pd.DataFrame) -> pd.DataFrame:
        found = {k for i, js in _near_in_block(frame, percent, least) for k in (i, *js.tolist())}
        return frame.iloc[sorted(found)][["key", "uid"]]

    dealt = _dealt(members).join(sets.sketches, "uid")
    seen = dealt.groupBy("key", "p", "q").applyInPandas(suspects, "key long, uid long").distinct()
    seen = stored(seen, f"{folder}/suspects")
    uids = stored(seen.select("uid").distinct(), f"{folder}/suspect-uids")
    whole = sets.of(uids)
    kept = members.join(seen, ["key", "uid"])
    shared = kept.groupBy("uid").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    # one row per set before they meet the members, who are many times as many
    each = shared.join(whole, "uid").join(sets.sketches, "uid")
    dealt = _dealt(kept).join(stored(each, f"{folder}/suspect-rows"), "uid")

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        out, label = [], {g: g for g in frame["group"]}
        keys = [set(k) for k in frame["keys"]]
        key, uid, group = frame["key"].iloc[0], frame["uid"].to_numpy(), frame["group"].to_numpy()
        shingles = frame["shingles"].to_list()

        def root(g):
            while label[g] != g:
                label[g] = g = label[label[g]]
            return g

        for i, js in _near_in_block(frame, percent, least):
            for j in js.tolist():
                a, b = root(group[i]), root(group[j])
                if a == b or min(keys[i] & keys[j]) != key:
                    continue
                inside = len(np.intersect1d(shingles[i], shingles[j], assume_unique=True))
                if 100 * inside >= percent * (len(shingles[i]) + len(shingles[j]) - inside):
                    label[max(a, b)] = min(a, b)
                    out.append((min(uid[i], uid[j]), max(uid[i], uid[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    found = dealt.groupBy("key", "p", "q").applyInPandas(links, "a long, b long")
    return stored(found, f"{folder}/links")


def near_links(
    docs: DataFrame, reps: DataFrame, shingle: int, percent: int, folder: str
) -> DataFrame:
    """(a, b) by uid: links that connect all sets at least `percent` similar. `reps` (uid, n,
    bands, sketch) is a stored table of one row per set.

    Small buckets list their pairs. In larger ones each member is compared with one of its bucket,
    then, turn by turn, with others while that joins many; what remains in different groups is
    compared in blocks, with every member of the others. Nothing is capped, and a bucket that holds a
    third of all rows never meets in one task.
    """
    keyed = reps.select("uid", "n", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = stored(keyed.join(sizes, "key"), f"{folder}/members")
    sets = Sets(docs, reps, shingle, percent, folder)
    open_ = members.where(F.col("members") > SMALL).withColumn("group", F.col("uid"))
    left = open_.count()
    first = _small_pairs(members, percent)
    if left:
        first = first.unionByName(_stars(open_, percent, 0)).distinct()
    links, turn = sets.verified(first), 0
    while left:
        turn += 1
        here = f"{folder}/turn-{turn}"
        open_ = _grouped(open_, links, here)
        left = open_.count()
        if not left:
            break
        more = sets.verified(_stars(open_, percent, turn))
        links = stored(links.unionByName(more), f"{here}/links")
        if more.count() * WORTHWHILE <= left:
            open_ = _grouped(open_, links, f"{here}/last")
            return links.unionByName(_block_links(open_, sets, f"{here}/blocks"))
    return links


def minhash_components(docs: DataFrame, shingle: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    The first pass over the texts writes signatures. Later ones read only texts whose signatures
    agree with another's, as sets of hashes.
    """
    folder = work_folder(docs.sparkSession, "minhash")
    signed = stored(signatures(docs, shingle), f"{folder}/signatures")
    digest = ["d1", "d2", "n"]
    one = F.min_by(F.struct("bands", "sketch"), "uid").alias("of")
    filled = signed.where("n > 0").groupBy(*digest)
    least = F.min("doc_id").alias("least")
    classes = filled.agg(F.min("uid").alias("uid"), least, F.count("*").alias("copies"), one)
    classes = classes.select(*digest, "uid", "least", "copies", "of.bands", "of.sketch")
    classes = stored(classes, f"{folder}/classes")
    links = near_links(docs, classes.select("uid", "n", "bands", "sketch"), shingle, percent, folder)
    roots = components(links, folder).withColumnRenamed("node", "uid")
    grouped = classes.select(*digest, "uid", "least", "copies").join(roots, "uid", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "uid"))
    total = grouped.groupBy("root").agg(F.min("least").alias("component"), F.sum("copies").alias("rows"))
    several = grouped.join(total.where("rows > 1"), "root").select(*digest, "component", F.lit(True).alias("met"))
    several = stored(several, f"{folder}/several")
    found = signed.select("doc_id", *digest).join(several, digest, "left")
    component = F.when(F.col("met"), F.col("component")).otherwise(F.col("doc_id"))
    found = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
