"""Repeated byte strings, by deep-shallow suffix sorting.

Suffixes that may repeat for 100 bytes (their anchors do) are sorted by their first 100 bytes:
multikey quicksort splits all open groups by eight bytes at a time down to a shallow depth, and
blind tries order what still agrees. Neighbours that agree in all 100 bytes are equal strings; the
earliest start of each keeps its place, the others are removed.

Rows: one per row of `docs`. A null text has no bytes. The order is by doc_id, null first; rows that
share a doc_id come in the order in which they are read. Texts of fewer than 100 bytes stay whole.
A removal may end within a code point, so what is kept is bytes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import stored, work_folder
from dqtable.llm.windows import Spec, Texts, judged, numbered, repeated

#: Bytes per window, per anchor, and the depth where tries take over.
WINDOW, GRAM, SHALLOW = 100, 32, 72
#: Bytes of contexts that are sorted at once, unless one key has more (at most _BUSY contexts).
_CHUNK = 1 << 20
#: Suffixes that are sorted at once.
_SUFFIXES = 1 << 19
#: Contexts of a key that one task takes; those of keys with more are cut into windows first.
_BUSY = 1 << 15
#: Contexts that are cut into windows at once.
_CUT = 1 << 12
_NAMES = ("key", "lead", "content", "windows", "doc_id", "uid", "start")


class BlindTrie:
    """Orders strings of one length: nodes hold a depth and a child per byte there.

    An insertion descends without comparing, compares once with the leaf it meets, and then knows
    the depth at which to branch. Strings that are equal share a leaf.
    """

    def __init__(self, first: bytes):
        self.root: list | int = 0
        self.strings = [first]

    def insert(self, text: bytes) -> int:
        """The leaf of `text`."""
        node = self.root
        while isinstance(node, list):
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
            if isinstance(node, tuple):
                node = node[0]
        if self.strings[node] == text:
            return node
        depth = _common(self.strings[node], text)
        self.strings.append(text)
        leaf = len(self.strings) - 1
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            parent, node = node, node[1][text[node[0]]]
            if isinstance(node, tuple):
                node = node[0]
        if isinstance(node, list) and node[0] == depth:
            node[1][text[depth]] = (leaf,)
            return leaf
        old = node if isinstance(node, list) else (node,)
        branch = [depth, {self._byte(node, depth): old, text[depth]: (leaf,)}]
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch
        return leaf

    def _byte(self, node: list | int, depth: int) -> int:
        """The byte at a depth that all strings below a node share."""
        while isinstance(node, list):
            node = next(iter(node[1].values()))
            if isinstance(node, tuple):
                node = node[0]
        return self.strings[node][depth]

    def ordered(self) -> list[int]:
        """The leaves in the order of their strings."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node[0] if isinstance(node, tuple) else node)
        return out


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings that differ."""
    low, high = 0, len(a)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def equal_classes(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int, shallow: int):
    """A number per suffix: equal if group and the first `length` bytes are.

    Numbers rise in the order of group, then string.
    """
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    order = np.argsort(groups, kind="stable")
    label = groups[order].astype(np.int64)
    label = np.cumsum(np.r_[0, label[1:] != label[:-1]]) if len(label) else label
    depth = 0
    while depth < shallow and len(label):
        open_ = _open(label)
        if not open_.any():
            break
        own = order[open_]
        part = words[starts[own] + depth].copy().view(">u8").ravel().astype(np.uint64)
        if depth + 8 > length:
            part &= np.uint64(0xFFFFFFFFFFFFFFFF << (8 * (depth + 8 - length)) & 0xFFFFFFFFFFFFFFFF)
        rank = np.lexsort((part, label[open_]))
        own, part, old = own[rank], part[rank], label[open_][rank]
        new = np.r_[False, (old[1:] != old[:-1]) | (part[1:] != part[:-1])]
        order[open_] = own
        step = np.zeros(len(label), np.int64)
        step[np.flatnonzero(open_)] = new
        fresh = np.r_[False, label[1:] != label[:-1]] | step.astype(bool)
        label = np.cumsum(fresh)
        depth += 8
    out = np.empty(len(order), np.int64)
    if depth < length and len(label):
        cut = np.r_[np.flatnonzero(np.r_[True, label[1:] != label[:-1]]), len(label)]
        place = np.arange(len(label))
        for a in np.flatnonzero(np.diff(cut) > 1).tolist():
            low, high = int(cut[a]), int(cut[a + 1])
            own = order[low:high]
            tails = [data[s + depth : s + length] for s in starts[own].tolist()]
            trie = BlindTrie(tails[0])
            leaf = np.array([0] + [trie.insert(t) for t in tails[1:]])
            rank = np.empty(len(trie.strings), np.int64)
            rank[trie.ordered()] = np.arange(len(trie.strings))
            place[low:high] = low + rank[leaf]
        out[order] = place  # within a group places differ exactly where strings do
        return out
    out[order] = label
    return out


def _open(label: np.ndarray) -> np.ndarray:
    """Members of groups that have several."""
    same = label[1:] == label[:-1]
    return np.r_[same, False] | np.r_[False, same]


def _firsts(rows: list[tuple], length: int, shallow: int) -> list[tuple[int, int]]:
    """(row, offset) of the windows that start first in contexts that share keys.

    rows: (key, lead, content, windows, doc_id, uid, start). A window lies `lead - i` before its
    anchor, and windows at different distances differ, so key and distance are a group.
    """
    data = b"".join(r[2] for r in rows)
    base = np.r_[0, np.cumsum([len(r[2]) for r in rows])][:-1].astype(np.int64)
    key = np.unique([r[0] for r in rows], return_inverse=True)[1]
    doc = np.array([-(1 << 63) if r[4] is None else r[4] for r in rows], np.int64)
    null = np.array([r[4] is not None for r in rows])
    uid, start = np.array([r[5] for r in rows], np.int64), np.array([r[6] for r in rows], np.int64)
    lead, many = np.array([r[1] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
    out = []
    # distances in runs, so that a key with many contexts is sorted a part at a time
    step = max(1, int(_SUFFIXES // max(1, len(rows))))
    for low in range(0, length, step):
        first = np.clip(lead - (low + step) + 1, 0, many)
        count = np.clip(lead - low + 1, 0, many) - first
        row = np.repeat(np.arange(len(rows)), count)
        if not len(row):
            continue
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
        group = key[row] * length + (lead[row] - at)
        label = equal_classes(data, base[row] + at, group, length, shallow)
        rank = np.lexsort((start[row] + at, uid[row], doc[row], null[row], label))
        best = rank[np.r_[True, label[rank][1:] != label[rank][:-1]]]
        out += zip(row[best].tolist(), at[best].tolist())
    return out


def _first_starts(rows: list[tuple], length: int, shallow: int) -> list[tuple[int, int, int]]:
    """(uid, start, windows) of the windows that start first in contexts that share keys."""
    return _ranges([(rows[i][5], rows[i][6] + at) for i, at in _firsts(rows, length, shallow)])


def _ranges(starts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Single starts as runs (uid, start, count)."""
    starts = sorted(starts)
    out = []
    for uid, at in starts:
        if out and out[-1][0] == uid and out[-1][1] + out[-1][2] == at:
            out[-1][2] += 1
        else:
            out.append([uid, at, 1])
    return [tuple(r) for r in out]


def _dealt(contexts: DataFrame, spec: Spec) -> DataFrame:
    """Contexts, those of busy keys as single windows whose key also tells distance and bytes.

    Where many texts share a passage, the windows over its edges make a context per text under one
    key. Equal windows have equal keys, distances and bytes, so they still meet; of those cut at
    once only the first goes on.
    """
    rows = contexts.select("key", "lead", "content", "windows", "first.*")
    busy = contexts.groupBy("key").count().where(F.col("count") > _BUSY).select("key")
    busy = stored(busy, work_folder(contexts.sparkSession, "busy-keys"))
    if busy.isEmpty():
        return rows

    def cut(batches):
        for batch in (b.slice(i, _CUT) for b in batches for i in range(0, b.num_rows, _CUT)):
            held = list(zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True))
            out = []
            for i, at in _firsts(held, spec.window, SHALLOW):
                key, lead, content, _, doc, uid, start = held[i]
                out.append((key, lead - at, content[at : at + spec.window], 1, doc, uid, start + at))
            columns = list(zip(*out, strict=True)) or [[]] * len(_NAMES)
            kinds = [batch.schema.field(c).type for c in _NAMES]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=list(_NAMES)
            )

    single = rows.join(busy, "key", "left_semi").select(*_NAMES)
    single = single.mapInArrow(cut, single.schema)
    single = single.withColumn("key", F.xxhash64("key", "lead", "content"))
    return rows.join(busy, "key", "left_anti").select(*_NAMES).unionByName(single)


def first_windows(contexts: DataFrame, spec: Spec) -> DataFrame:
    """(uid, start, windows): where each distinct window starts first, by sorting contexts per key.

    A key with one context needs no sorting: its first place owns all windows. Rows of a partition
    come ordered by key and are sorted some keys at a time.
    """
    dealt = _dealt(contexts, spec).repartition("key")

    def batch_of(rows):
        kinds = (pa.int64(), pa.int64(), pa.int32())
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["uid", "start", "windows"],
        )

    def run(batches):
        held, group, size = [], [], 0
        for batch in batches:
            alone = []
            for row in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
                if group and group[0][0] != row[0]:
                    if len(group) == 1:
                        alone.append((group[0][5], group[0][6], group[0][3]))
                    else:
                        held += group
                        size += sum(len(r[2]) for r in group)
                    group = []
                    if size > _CHUNK:
                        yield batch_of(_first_starts(held, spec.window, SHALLOW))
                        held, size = [], 0
                group.append(row)
            yield batch_of(alone)
        if len(group) == 1:
            yield batch_of([(group[0][5], group[0][6], group[0][3])])
        else:
            held += group
        if held:
            yield batch_of(_first_starts(held, spec.window, SHALLOW))

    return dealt.sortWithinPartitions("key").mapInArrow(run, "uid long, start long, windows int")


def without_repeated_bytes(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, kept: bool = True
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, unless told otherwise, kept) per row."""
    spec = Spec("byte", window, gram)
    rows = numbered(docs)
    found = repeated(rows, spec, first_windows, work_folder(docs.sparkSession, "suffixes"))

    def judge(own: Texts, removed):
        data = np.frombuffer(own.data, np.uint8)
        out = []
        for start, length in zip(own.start.tolist(), own.length.tolist(), strict=True):
            gone = removed[start : start + length]
            left = data[start : start + length]
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (length > 0 and gone[0]))
            left = left[~gone].tobytes() if spans else left.tobytes()
            out.append((length, length - len(left), spans, left))
        columns = [pa.array([o[k] for o in out], pa.int64()) for k in range(3)]
        columns += [pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string())]
        return columns + [pa.array([o[3] for o in out], pa.binary())] * kept

    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    return judged(rows, found, spec, schema, judge)
