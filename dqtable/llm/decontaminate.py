"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents.

An item's windows are its runs of `window` words; an item with fewer words (but not none) is one
window. A window occurs in a document if all its word shingles do, so its rarest shingle alone must:
shingles are ordered by how often the documents hold them, and only that one (the necessary prefix)
is joined. A hit fixes where the window would begin; it must fit between the document's ends (length
and position bounds), and then all of its words are compared.

Rows: one per row of `docs`. A null or wordless text has no words and no hits; wordless items and
items with a null text have no windows. Items that repeat under several ids all count; a null
item_id takes part in hits but not in the list of items. Other columns are ignored, or kept whole
by `drop_contaminated`.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import fill, pieces, stored, work_folder

#: Words of items that are matched in one pass over the documents (about 100 MB in a task). Their
#: shingles, numbers of three words, stay below 63 bits.
BLOCK_WORDS = 1_000_000
SHINGLE = 3
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or c >= 0x61 and c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: digits, letters and everything beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


class Windows:
    """The distinct windows of a block of items, as word numbers."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.ids = sorted({item for item, _ in items if item is not None})
        number = {item: i for i, item in enumerate(self.ids)}
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i : i + window]), set()).add(number.get(item, -1))
        self.vocabulary = vocabulary
        self.base = len(vocabulary) + 1
        if self.base**SHINGLE >= 1 << 63:
            raise ValueError(f"{len(vocabulary)} words in a block: their shingles have no number")
        self.length = np.array([len(w) for w in owners], np.int64)
        self.words = np.zeros((len(owners), window), np.int64)
        for i, w in enumerate(owners):
            self.words[i, : len(w)] = w
        self.owner_at = np.r_[0, np.cumsum([len(o) for o in owners.values()])].astype(np.int64)
        self.owner = np.fromiter(chain.from_iterable(sorted(o) for o in owners.values()), np.int64)
        self.span = np.minimum(self.length, SHINGLE)
        self.spans = sorted(set(self.span.tolist()))

    @classmethod
    def of(cls, fields: dict) -> Windows:
        """From plain fields, which is what a broadcast carries."""
        own = cls.__new__(cls)
        own.__dict__.update(fields)
        return own

    def keys(self, ids: np.ndarray, span: int) -> np.ndarray:
        """A number per shingle of `span` words that starts at a position; -1 if none does."""
        if len(ids) < span:
            return np.zeros(0, np.int64)
        count = len(ids) - span + 1
        key, known = np.zeros(count, np.int64), np.ones(count, bool)
        for k in range(SHINGLE):
            word = ids[k : count + k] if k < span else np.zeros(count, np.int64)
            key = key * self.base + word
            known &= (word > 0) | (k >= span)
        return np.where(known, key, -1)

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, offset, key) of every shingle of every window."""
        found = []
        for span in self.spans:
            own = np.flatnonzero(self.span == span)
            for offset in range(self.words.shape[1] - span + 1):
                fits = own[self.length[own] >= offset + span]
                key = np.zeros(len(fits), np.int64)
                for k in range(SHINGLE):
                    word = self.words[fits, offset + k] if k < span else 0
                    key = key * self.base + word
                found.append((fits, np.full(len(fits), offset), key))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        window, offset, key = (np.concatenate(c) for c in zip(*found, strict=True))
        return window, offset, key

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of several texts (0: not in any item), with a 0 after each text.

        Also where each text starts and how many words it has.
        """
        lists = [words_of(t) for t in texts]
        count = np.array([len(w) for w in lists], np.int64)
        start = np.r_[0, np.cumsum(count + 1)][:-1].astype(np.int64)
        ids = np.zeros(int(count.sum()) + len(lists), np.int64)
        flat = map(self.vocabulary.get, chain.from_iterable(lists), repeat(0))
        place = np.ones(len(ids), bool)
        place[start + count] = False
        ids[place] = np.fromiter(flat, np.int64, int(count.sum()))
        return ids, start, count

    def set_prefixes(self, frequency: dict[int, int]) -> None:
        """Choose each window's rarest shingle (ties: smaller key, then first place)."""
        window, offset, key = self.shingles()
        seen = np.array([frequency.get(int(k), 0) for k in key], np.int64)
        order = np.lexsort((offset, key, seen, window))
        first = order[np.r_[True, window[order][1:] != window[order][:-1]]] if len(order) else order
        first = first[seen[first] > 0]  # a window whose shingle no document has occurs nowhere
        first = first[np.argsort(key[first], kind="stable")]
        self.p_window, self.p_offset, self.p_key = window[first], offset[first], key[first]

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence in numbered texts."""
        at, which = [], []
        for span in self.spans:
            key = self.keys(ids, span)
            low = np.searchsorted(self.p_key, key, "left")
            many = np.searchsorted(self.p_key, key, "right") - low
            many[key < 0] = 0
            hit = np.flatnonzero(many)
            place = np.repeat(hit, many[hit])
            step = np.arange(len(place)) - np.repeat(np.cumsum(many[hit]) - many[hit], many[hit])
            prefix = np.repeat(low[hit], many[hit]) + step
            window = self.p_window[prefix]
            start = place - self.p_offset[prefix]
            fits = (start >= 0) & (start + self.length[window] <= len(ids))
            start, window = start[fits], window[fits]
            for k in range(self.words.shape[1]):  # words of other texts lie behind a 0
                same = self.length[window] <= k
                inside = np.flatnonzero(~same)
                same[inside] = ids[start[inside] + k] == self.words[window[inside], k]
                start, window = start[same], window[same]
            at.append(start)
            which.append(window)
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(at), np.concatenate(which)


def _count_shingles(docs: DataFrame, windows: Windows) -> dict[int, int]:
    """How often all documents hold each shingle of the block."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(windows))

    def run(batches):
        own = Windows.of(sent.value)
        keys = np.unique(own.shingles()[2])
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                ids = own.numbers(texts)[0]
                for span in own.spans:
                    found = own.keys(ids, span)
                    place = np.searchsorted(keys, found)
                    place[place == len(keys)] = 0
                    known = keys[place] == found
                    total += np.bincount(place[known], minlength=len(keys))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(total[some])], ["k", "n"])

    counts = docs.select(fill().alias("text")).mapInArrow(run, "k long, n long")
    return {r.k: r.n for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}


def _item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, text, n): the words of each item once, in pieces of at most BLOCK_WORDS that overlap
    by all but one word of a window, so every window lies in one of them."""
    most = max(BLOCK_WORDS, window)
    step = most - window + 1

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                items, out, count = part.column("item").to_pylist(), [], []
                own = []
                for item, text in zip(items, texts, strict=True):
                    words = words_of(text)
                    last = max(0, len(words) - window) if words else -1
                    for start in range(0, last + 1, step):
                        cut = words[start : start + most]
                        own.append(item)
                        out.append(b" ".join(cut).decode())
                        count.append(len(cut))
                columns = [pa.array(own, pa.string()), pa.array(out, pa.string()), pa.array(count, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "text", "n"])

    items = benchmark.where("text is not null")
    items = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    return items.mapInArrow(run, "item string, text string, n long")


def _parts(items: DataFrame, parts: int, salt: int = 0):
    """The items by parts of a hash; a part beyond BLOCK_WORDS is parted again."""
    part = F.pmod(F.xxhash64("item", "text", F.lit(salt)), F.lit(parts))
    keyed = items.withColumn("part", part)
    sizes = keyed.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    for r in sorted(sizes.collect()):
        own = keyed.where(F.col("part") == r.part).drop("part")
        if r.n > BLOCK_WORDS and r.rows > 1:
            yield from _parts(own, max(2, -(-2 * r.n // BLOCK_WORDS)), salt + 1)
        else:
            yield own


def blocks(docs: DataFrame, benchmark: DataFrame, window: int):
    """The items in blocks of at most BLOCK_WORDS words, ready to match.

    A block can go to the driver and to every task; more items mean more passes over the documents.
    Repeated rows are merged and long items cut before, so the bound holds for any benchmark.
    """
    folder = work_folder(docs.sparkSession, "items")
    items = stored(_item_pieces(benchmark, window), folder)
    total = items.agg(F.sum("n")).first()[0] or 0
    for part in _parts(items, -(-total // BLOCK_WORDS)) if total else ():
        block = Windows([(r.item, r.text.encode()) for r in part.collect()], window)
        block.set_prefixes(_count_shingles(docs, block))
        yield block


def annotated(docs: DataFrame, benchmark: DataFrame, carry: list[str], window: int) -> DataFrame:
    """`carry` columns of `docs` (which needs `text`), n_words, hit runs and the items found.

    Documents stream through once per block and are not shuffled; between blocks they are written.
    """
    spark = docs.sparkSession
    docs = docs.select(*carry, fill().alias("text"))
    rows = docs.withColumn("n_words", F.lit(None).cast("long"))
    rows = rows.withColumn("runs", F.lit(None).cast("array<long>"))
    rows = rows.withColumn("items", F.lit(None).cast("array<string>"))
    folder = work_folder(spark, "decontaminate")
    matched = False
    for number, block in enumerate(blocks(docs, benchmark, window)):
        if matched:
            rows = stored(rows, f"{folder}/{number}")
        rows, matched = _match(rows, block, carry), True
    if not matched:
        rows = _match(rows, Windows([], window), carry)
    return rows


def _match(rows: DataFrame, block: Windows, carry: list[str]) -> DataFrame:
    if not hasattr(block, "p_key"):
        block.set_prefixes({})
    sent = rows.sparkSession.sparkContext.broadcast(vars(block))
    names = [*carry, "text", "n_words", "runs", "items"]

    def run(batches):
        own = Windows.of(sent.value)
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                runs, items, count = _hits(own, texts)
                old_runs, old_items = part.column("runs").to_pylist(), part.column("items").to_pylist()
                both = [sorted({*(o or ()), *n}) for o, n in zip(old_items, items, strict=True)]
                merged = [_merge((o or []) + n) for o, n in zip(old_runs, runs, strict=True)]
                columns = [part.column(part.schema.get_field_index(c)) for c in [*carry, "text"]]
                columns += [pa.array(count)]
                columns += [pa.array(merged, pa.list_(pa.int64())), pa.array(both, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*names).mapInArrow(run, rows.select(*names).schema)


def _hits(own: Windows, texts: list[bytes]) -> tuple[list[list[int]], list[list[str]], np.ndarray]:
    """Per text: runs of hit words as [start, end, start, end ...], items found, words."""
    ids, start, count = own.numbers(texts)
    at, window = own.occurrences(ids)
    runs: list[list[int]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    if len(at):
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + own.length[window], -1)
        hit = np.r_[False, np.cumsum(edge)[:-1] > 0, False]
        ups, downs = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:])
        doc = np.searchsorted(start, ups, "right") - 1
        for d, a, b in zip(doc.tolist(), ups.tolist(), downs.tolist(), strict=True):
            runs[d] += [a - int(start[d]), b - int(start[d])]
        doc = np.searchsorted(start, at, "right") - 1
        pairs = np.unique(doc * len(own.length) + window)
        for d, w in zip((pairs // len(own.length)).tolist(), (pairs % len(own.length)).tolist(), strict=True):
            owners = own.owner[own.owner_at[w] : own.owner_at[w + 1]]
            items[d] += [own.ids[o] for o in owners.tolist() if o >= 0]
    return runs, items, count


def _merge(runs: list[int]) -> list[int]:
    """The union of runs, as sorted runs that do not touch."""
    out: list[int] = []
    for a, b in sorted(zip(runs[::2], runs[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_runs) per row."""
    found = annotated(docs, benchmark, ["doc_id"], window)
    ends = F.filter("runs", lambda _, i: i % 2 == 1)
    starts = F.filter("runs", lambda _, i: i % 2 == 0)
    hit = F.aggregate(F.zip_with(ends, starts, lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.col("runs").alias("hit_runs"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of `docs` without an occurrence of any window, all columns."""
    whole = docs.select(F.struct("*").alias("doc"), "text")
    return annotated(whole, benchmark, ["doc"], window).where("size(runs) = 0").select("doc.*")

