"""Language-model scores: a gated recurrent network beside an add-one unigram.

Words that training documents hold are counted over the whole corpus. The network sees the most
frequent ones and a common token for the rest, whose share is divided by add-one counts, so every
text has a proper probability. It learns by truncated backpropagation: tasks train on their own
documents from common weights, and the weights are averaged; each training document is used once.
For scores, the state runs on from window to window through the whole document.

Rows: one per row of `docs`. A null text is an empty one: its only token is the end. A null doc_id
counts as an empty string for the split. Repeated rows are counted and scored as often as they
occur; they are told apart by a row number. Without training documents the first weights score.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import fill, pieces, stored, work_folder

#: Classes of the output, words per class, and width of embeddings and state.
CLASSES, CLASS_SIZE, WIDTH = 32, 32, 16
VOCABULARY = CLASSES * CLASS_SIZE
#: Steps per window of truncated backpropagation, documents side by side, and tokens per lane that
#: make another lane worth while.
STEPS, LANES, PER_LANE = 32, 512, 2000
#: Training cuts longer documents, so that lanes end together; scoring never does.
SEGMENT = 2048
#: Rounds of training, each on its share of the documents, and Adagrad's step.
ROUNDS, RATE = 3, 0.15
#: Words whose counts go to every task, and bytes of the longest one; the others' counts are joined.
KNOWN, LONGEST = 200_000, 64
#: Parts of the words of equal count at the edge of the known ones.
PARTS = 4096
#: Distinct words that a counting task holds before it hands them on; it adds up slices' counts when
#: they have twice as many rows.
HELD = 400_000
#: Tokens that a task trains on or scores at once.
CHUNK = 3_000_000
#: Sets of weights that one task, or the driver at last, adds up.
FAN_IN = 64
#: Rows of a softmax that are worked on while they are in the cache.
ROWS = 2048
END, REST = 0, 1
#: Short ids sort by radix.
_ID = np.int16 if VOCABULARY <= 1 << 15 else np.int32
_SHAPES = {
    "table": (VOCABULARY, WIDTH),
    "input": (WIDTH, 3 * WIDTH),
    "bias": (3 * WIDTH,),
    "state": (WIDTH, 3 * WIDTH),
    "class": (WIDTH, CLASSES),
    "class_bias": (CLASSES,),
    "word": (CLASSES, WIDTH, CLASS_SIZE),
    "word_bias": (CLASSES, CLASS_SIZE),
}


def held_out():
    """Whether a document is kept from training."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, one after the other, and the number that each text has.

    The ends that follow the texts are not among them.
    """
    # these kernels look at bytes, so the bytes need not be UTF-8
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    words = lists.flatten()
    real = np.asarray(pc.binary_length(words)) > 0  # blanks around a text leave empty words
    before = np.zeros(len(real) + 1, np.int64)
    np.cumsum(real, out=before[1:])
    if not real.all():
        words = words.filter(pa.array(real))
    return words.view(pa.binary()), np.diff(before[np.asarray(lists.offsets)])


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each word stands among the known ones; -1: nowhere."""
    return np.asarray(pc.fill_null(pc.index_in(words, value_set=known), -1))


def first_weights(used: int) -> dict[str, np.ndarray]:
    """Weights before training, for a vocabulary of which `used` ids have a word."""
    random = np.random.default_rng(7)
    out = {
        name: (random.standard_normal(shape) * (0.0 if "bias" in name else 0.1)).astype(np.float32)
        for name, shape in _SHAPES.items()
    }
    ids = np.arange(VOCABULARY).reshape(CLASSES, CLASS_SIZE)
    out["word_bias"][ids >= used] = -30
    out["class_bias"][ids[:, 0] >= used] = -30
    return out


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in _SHAPES])


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        out[name] = np.array(flat[at : at + size], np.float32).reshape(shape)
        at += size
    return out


@dataclass
class Lanes:
    """Documents side by side: targets per step and lane (-1: none), starts, document numbers."""

    target: np.ndarray
    start: np.ndarray
    doc: np.ndarray
    active: np.ndarray  # lanes in use per step; lanes come longest first

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Lanes:
        longest, total = max(map(len, docs)), sum(map(len, docs))
        # few lanes where one long document would leave most of the table of lanes empty
        count = int(np.clip(min(total // PER_LANE, 4 * total // longest), 1, LANES))
        loads = [(0, lane, []) for lane in range(count)]
        for number in sorted(range(len(docs)), key=lambda i: (-len(docs[i]), i)):
            load, lane, own = heapq.heappop(loads)
            own.append(number)
            heapq.heappush(loads, (load + len(docs[number]), lane, own))
        loads.sort(key=lambda x: (-x[0], x[1]))
        steps = loads[0][0]
        target = np.full((steps, count), -1, np.int32)
        start = np.zeros((steps, count), bool)
        doc = np.zeros((steps, count), np.int32)
        for lane, (_, _, own) in enumerate(loads):
            at = 0
            for number in own:
                stop = at + len(docs[number])
                target[at:stop, lane] = docs[number]
                start[at, lane] = True
                doc[at:stop, lane] = number
                at = stop
        lengths = np.array([load for load, _, _ in loads])
        active = np.searchsorted(-lengths, -np.arange(steps), "left")
        return cls(target, start, doc, active)


def _sigmoid(x: np.ndarray) -> None:
    """Overwrites `x`."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.divide(1, x, out=x)


def _softmax(x: np.ndarray, pick: np.ndarray, bound: float, learn: bool) -> np.ndarray:
    """Log probability of the picked entry; to learn, `x` becomes the gradient of its negative.

    `bound`: no entry is larger. Rows are shifted by it only where exp could overflow.
    """
    if bound > 60:
        x -= bound - 60
    flat, at = x.reshape(-1), np.arange(len(x)) * x.shape[1] + pick
    picked = flat[at]
    total, ones = np.empty(len(x), x.dtype), np.ones(x.shape[1], x.dtype)
    for low in range(0, len(x), ROWS):
        part = x[low : low + ROWS]
        np.exp(part, out=part)
        np.matmul(part, ones, out=total[low : low + ROWS])
        if learn:
            part /= total[low : low + ROWS, None]
    if learn:
        flat[at] -= 1
    return picked - np.log(total)


def _apart(gates: np.ndarray) -> np.ndarray:
    """Rows of three gates side by side, as three arrays (views)."""
    return gates.reshape(len(gates), 3, WIDTH).transpose(1, 0, 2)


def _bound(weights: np.ndarray, bias: np.ndarray) -> float:
    """The largest logit that a state within -1 and 1 can give."""
    return float((np.abs(weights).sum(-2) + bias).max())


class Network:
    """The forward pass over windows, and on demand the gradients."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    def window(self, ids, start, target, mask, state, learn: bool):
        """Inputs, document starts, targets and used places (steps x lanes), state before.

        Returns log probabilities (natural), the state behind, and the gradients.
        """
        w = self.weights
        steps, lanes = ids.shape
        # the three gates apart, so that each is contiguous
        table = _apart(w["table"] @ w["input"] + w["bias"]).copy()
        fresh = start.any(1)
        before = np.empty((steps, lanes, WIDTH), np.float32)
        after = np.empty_like(before)
        kept = []
        for t in range(steps):
            old = before[t]
            old[...] = state
            if fresh[t]:
                old[start[t]] = 0
            inner = _apart(old @ w["state"])
            gates = np.take(table, ids[t], axis=1)
            zr = gates[:2]
            zr += inner[:2]
            _sigmoid(zr)
            z, r, n = gates
            n += r * inner[2]
            np.tanh(n, out=n)
            state = np.subtract(old, n, out=after[t])
            state *= z
            state += n
            if learn:
                kept.append((z, r, n, inner[2]))
        hidden, goal = after.reshape(-1, WIDTH), target.ravel()
        place = slice(None) if mask.all() else np.flatnonzero(mask.ravel())
        log_p, d_hidden, grad = self._output(hidden[place], goal[place], learn)
        out = np.zeros(steps * lanes, np.float64)
        out[place] = log_p
        if learn:
            d_out = np.zeros((steps * lanes, WIDTH), np.float32)
            d_out[place] = d_hidden
            grad |= self._back(ids, start, before, kept, d_out.reshape(after.shape))
        return out.reshape(steps, lanes), state, grad

    def _output(self, hidden: np.ndarray, goal: np.ndarray, learn: bool):
        """Log probability of the class, plus that of the word within it."""
        w = self.weights
        group, word = np.divmod(goal, CLASS_SIZE)
        d = hidden @ w["class"]
        d += w["class_bias"]
        log_p = _softmax(d, group, _bound(w["class"], w["class_bias"]), learn).astype(np.float64)
        grad: dict[str, np.ndarray] = {}
        d_hidden = None
        if learn:
            grad = {"class": hidden.T @ d, "class_bias": d.sum(0)}
            grad |= {n: np.zeros(_SHAPES[n], np.float32) for n in ("word", "word_bias")}
            d_hidden = d @ w["class"].T
        order = np.argsort(group.astype(_ID), kind="stable")
        cut = np.searchsorted(group[order], np.arange(CLASSES + 1))
        ordered, pick = np.take(hidden, order, axis=0), word[order]
        bound = _bound(w["word"], w["word_bias"])
        inner, back = np.empty(len(order)), np.empty_like(ordered)
        for c in range(CLASSES):
            own = slice(cut[c], cut[c + 1])
            part = ordered[own]
            if not len(part):
                continue
            d = part @ w["word"][c]
            d += w["word_bias"][c]
            inner[own] = _softmax(d, pick[own], bound, learn)
            if learn:
                grad["word"][c], grad["word_bias"][c] = part.T @ d, d.sum(0)
                back[own] = d @ w["word"][c].T
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        log_p += inner[place]
        if learn:
            d_hidden += np.take(back, place, axis=0)
        return log_p, d_hidden, grad

    def _back(self, ids, start, before, kept, d_out) -> dict[str, np.ndarray]:
        w = self.weights
        steps, lanes = ids.shape
        d_inner = np.empty((steps, lanes, 3 * WIDTH), np.float32)
        d_gates = np.empty_like(d_inner)
        carry = np.zeros((lanes, WIDTH), np.float32)
        back, fresh = w["state"].T.copy(), start.any(1)
        for t in range(steps - 1, -1, -1):
            z, r, n, inner = kept[t]
            d = d_out[t]
            d += carry
            rest = 1 - z
            d_n = d * rest
            d_n *= 1 - n * n
            d_z = before[t] - n
            d_z *= d
            d_z *= z
            d_z *= rest
            d_r = d_n * inner
            d_r *= r
            d_r *= 1 - r
            d_gates[t, :, :WIDTH] = d_inner[t, :, :WIDTH] = d_z
            d_gates[t, :, WIDTH : 2 * WIDTH] = d_inner[t, :, WIDTH : 2 * WIDTH] = d_r
            d_gates[t, :, 2 * WIDTH :] = d_n
            d_inner[t, :, 2 * WIDTH :] = d_n * r
            carry = d * z
            carry += d_inner[t] @ back
            if fresh[t]:
                carry[start[t]] = 0
        flat = d_gates.reshape(-1, 3 * WIDTH)
        order = np.argsort(ids.ravel().astype(_ID), kind="stable")
        sorted_ids = ids.ravel()[order]
        cut = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
        by_word = np.zeros((VOCABULARY, 3 * WIDTH), np.float32)
        by_word[sorted_ids[cut]] = np.add.reduceat(np.take(flat, order, axis=0), cut, axis=0)
        return {
            "table": by_word @ w["input"].T,
            "input": w["table"].T @ by_word,
            "bias": by_word.sum(0),
            "state": before.reshape(-1, WIDTH).T @ d_inner.reshape(-1, 3 * WIDTH),
        }


def run_lanes(network: Network, docs: list[np.ndarray], step=None) -> np.ndarray:
    """Natural log probability per document (ids with the end); `step` gets gradients to learn."""
    scores = np.zeros(len(docs))
    if not docs:
        return scores
    lanes = Lanes.of(docs)
    state = np.zeros((lanes.target.shape[1], WIDTH), np.float32)
    previous = np.full(lanes.target.shape[1], END)
    for low in range(0, len(lanes.target), STEPS):
        width = int(lanes.active[low])
        cut = (slice(low, low + STEPS), slice(0, width))
        target, start = lanes.target[cut], lanes.start[cut]
        mask = target >= 0
        ids = np.vstack([previous[None, :width], target[:-1]])
        ids = np.where(start | (ids < 0), END, ids)
        found, state, grad = network.window(ids, start, target, mask, state[:width], step is not None)
        previous = target[-1]
        np.add.at(scores, lanes.doc[cut][mask], found[mask])
        if step is not None:
            step(grad, int(mask.sum()))
    return scores


class Adagrad:
    """Steps along mean gradients, divided by their size so far."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self.square = {k: np.full_like(v, 1e-6) for k, v in weights.items()}

    def __call__(self, grad: dict[str, np.ndarray], count: int) -> None:
        for name, g in grad.items():
            g = np.clip(g / max(count, 1), -1, 1)
            self.square[name] += g * g
            self.weights[name] -= RATE * g / np.sqrt(self.square[name])


def _numbered(at: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Per text, the network's ids and the end; `at`: places of words among the known ones."""
    stops = size.cumsum() + np.arange(len(size))
    ids = np.full(len(at) + len(size), END, np.int32)
    place = np.ones(len(ids), bool)
    place[stops] = False
    ids[place] = np.where((at >= 0) & (at < VOCABULARY - 2), at + 2, REST)
    return np.split(ids, stops[:-1] + 1)


def _segments(docs: list[np.ndarray]) -> list[np.ndarray]:
    return [d[i : i + SEGMENT] for d in docs for i in range(0, len(d), SEGMENT)]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all training documents; the end of a document is the empty word.

    Tasks count before they shuffle, and hand on what they hold when it grows large.
    """

    def run(batches):
        def merged(held):
            sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
            return sums.select(["word", "c_sum"]).rename_columns(["word", "c"])

        held, rows = [], 0
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                words, counts = words_of(texts)[0].value_counts().flatten()
                held.append(pa.table({"word": words, "c": counts}))
                held.append(pa.table({"word": pa.array([b""], pa.binary()), "c": pa.array([len(texts)], pa.int64())}))
                rows += len(words) + 1
                if rows > 2 * HELD:
                    held = [merged(held)]
                    rows = len(held[0])
                    if rows > HELD:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from merged(held).to_batches()

    counted = docs.where(~held_out()).select(fill().alias("text"))
    counted = counted.mapInArrow(run, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def _frequent(counts: DataFrame) -> dict[bytes, int]:
    """The most frequent words with their counts, at most KNOWN, most frequent first.

    Words are counted by the magnitude of their counts, and whole magnitudes taken; the one that
    crosses KNOWN is taken by count, and the count that crosses it by parts of a hash. So a task
    sends the driver no word that is not among them.
    """
    words = counts.where((F.octet_length("word") > 0) & (F.octet_length("word") <= LONGEST))
    words = words.withColumn("size", F.floor(F.log2("c") * 64).cast("int"))
    words = words.withColumn("part", -F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    taken, level, room = F.lit(False), F.lit(True), KNOWN
    for name in ("size", "c", "part"):
        edge = None
        for r in sorted(words.where(level).groupBy(name).count().collect(), key=lambda r: -r[name]):
            if r["count"] > room:
                edge = r[name]
                break
            room -= r["count"]
        if edge is None:
            taken |= level
            break
        taken |= level & (F.col(name) > edge)
        level &= F.col(name) == edge
    rows = words.where(taken).select("word", "c").collect()
    rows = sorted(((bytes(r.word), r.c) for r in rows), key=lambda r: (-r[1], r[0]))
    return dict(rows)


def trained(
    docs: DataFrame, frequent: list[bytes], folder: str, rounds: int = ROUNDS
) -> dict[str, np.ndarray]:
    """Weights after all rounds; each round averages what the tasks learned from its documents.

    The tasks' weights are written and added up in levels, FAN_IN at a time.
    """
    spark = docs.sparkSession
    weights = first_weights(len(frequent) + 1)
    known = spark.sparkContext.broadcast(frequent)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for number in range(rounds):
        now = spark.sparkContext.broadcast(packed(weights))

        def run(batches, now=now):
            own, words = unpacked(now.value), pa.array(known.value, pa.binary())
            network, step, held, size, total = Network(own), Adagrad(own), [], 0, 0
            for batch in batches:
                for _, texts in pieces(batch, "text"):
                    found, sizes = words_of(texts)
                    held += _numbered(_places(found, words), sizes)
                    size += len(found) + len(sizes)
                    if size > CHUNK:
                        run_lanes(network, _segments(held), step)
                        held, size, total = [], 0, total + size
            run_lanes(network, _segments(held), step)
            total += size
            flat = (packed(own).astype("<f8") * total).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([total] if total else [], pa.int64()), pa.array([flat] if total else [], pa.binary())],
                names=["n", "weights"],
            )

        part = docs.where(~held_out() & (share == number)).select(fill().alias("text"))
        learned = part.mapInArrow(run, "n long, weights binary")
        learned = learned.withColumn("part", F.spark_partition_id())
        level = 0
        learned = stored(learned, f"{folder}/round-{number}-{level}")
        while learned.count() > FAN_IN:
            level += 1
            dealt = learned.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
            merged = dealt.groupBy("part").applyInArrow(_added, "n long, weights binary, part int")
            learned = stored(merged, f"{folder}/round-{number}-{level}")
        sums = learned.collect()
        total = sum(r.n for r in sums)
        if total:
            flat = [np.frombuffer(r.weights, "<f8") for r in sorted(sums, key=lambda r: r.weights)]
            weights = unpacked(sum(flat) / total)
    return weights


def _added(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
    """Weights of several tasks, each multiplied by its tokens, added in one order."""
    flat = sum(np.frombuffer(w, "<f8") for w in sorted(rows["weights"].to_pylist()))
    columns = [
        pa.array([sum(rows["n"].to_pylist())], pa.int64()),
        pa.array([flat.tobytes()], pa.binary()),
        pa.array([key[0].as_py()], pa.int32()),
    ]
    return pa.Table.from_arrays(columns, names=["n", "weights", "part"])


def _looked_up(texts: list[bytes], known: pa.Array, logs: np.ndarray):
    """What a slice of texts gives without the counts of rare words.

    `known`: the known words, most frequent first; `logs` has their log10 counts plus one. Per text:
    the network's ids with the end, (words + 1, log_c, words that it takes for REST, their log_c), and
    the words that are not known: how many each text has, which, and how often.
    """
    words, size = words_of(texts)
    doc = np.repeat(np.arange(len(size)), size)
    at = _places(words, known)
    inside = (at >= 0) & (at < VOCABULARY - 2)
    log = np.where(at >= 0, logs[at], 0.0)

    def per_text(values):
        return np.bincount(doc, values, len(size)).astype(np.float64)

    sums = (size + 1, per_text(log), per_text(~inside).astype(np.int64), per_text(np.where(inside, 0.0, log)))
    rare = np.flatnonzero(at < 0)
    coded = words.take(pa.array(rare)).dictionary_encode()
    distinct = max(len(coded.dictionary), 1)
    keys, times = np.unique(doc[rare] * distinct + np.asarray(coded.indices), return_counts=True)
    owner, code = np.divmod(keys, distinct)
    tails = np.bincount(owner, minlength=len(size)), coded.dictionary.take(pa.array(code)), times.astype(np.int32)
    return _numbered(at, size), sums, tails


def _scored(docs: DataFrame, known: dict[bytes, int], weights) -> DataFrame:
    """Per row, what the task can tell without the counts of rare words, and those words."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((list(known), list(known.values()), packed(weights)))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        held_out().alias("held_out"),
        fill().alias("text"),
    )
    fields = "n_tokens long, log_c double, rest long, log_rest double, log_net double"

    def run(batches):
        words, counts, flat = sent.value
        network = Network(unpacked(flat))
        known = pa.array(words, pa.binary())
        logs = np.log10(np.array([*counts, 0], np.float64) + 1)

        def finish(parts, found, docs):
            net = run_lanes(network, docs) / np.log(10)
            at = 0
            for part, (sums, tails) in zip(parts, found, strict=True):
                columns = [part.column(c) for c in ("uid", "doc_id", "held_out")]
                columns += [pa.array(s) for s in sums]
                columns.append(pa.array(net[at : at + part.num_rows]))
                lengths, own, times = tails
                offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
                struct = pa.StructArray.from_arrays([own, pa.array(times)], names=["word", "times"])
                columns.append(pa.ListArray.from_arrays(offsets, struct))
                names = ["uid", "doc_id", "held_out", *(f.split()[0] for f in fields.split(", ")), "tail"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += part.num_rows

        parts, found, held, size = [], [], [], 0
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                ids, sums, tails = _looked_up(texts, known, logs)
                found.append((sums, tails))
                held += ids
                size += int(sums[0].sum())
                parts.append(part.select(["uid", "doc_id", "held_out"]))
                if size > CHUNK:
                    yield from finish(parts, found, held)
                    parts, found, held, size = [], [], [], 0
        yield from finish(parts, found, held)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, held_out boolean, {fields}, tail array<struct<word:binary,times:int>>"
    return rows.mapInArrow(run, schema)


def language_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Counts of frequent words go to the tasks, bounded in number; what rare words add is summed by a
    join of their counts with each document's rare words, so no table of all words is broadcast.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "language")
    counts = stored(count_words(docs), f"{folder}/counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = total.n or 0, total.v
    known = _frequent(counts)
    frequent = list(known)[: VOCABULARY - 2]
    weights = trained(docs, frequent, folder)
    scored = stored(_scored(docs, known, weights), f"{folder}/scored")
    ends = tokens and (counts.where("word = x''").first().c or 0)
    # what the network leaves to the common token: words outside its vocabulary, and unseen ones
    rest = tokens - ends - sum(known[w] for w in frequent)
    rest += distinct - (1 if tokens else 0) - len(frequent) + 1
    tails = scored.select("uid", F.explode("tail").alias("t")).select("uid", "t.*")
    tails = tails.join(counts, "word", "left").groupBy("uid")
    tails = tails.agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("log_tail"),
        F.sum("times").alias("n_tail"),
        F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("known_tail"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    both = scored.join(tails, "uid", "left")
    log_end = float(np.log10(ends + 1))
    base = F.col("log_c") + log_end + zero("log_tail")
    unseen = F.lit(0 if tokens else 1)  # without training documents not even the end is known
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_tokens") - zero("n_tail") + zero("known_tail") - unseen).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * float(np.log10(tokens + distinct + 1))).alias("base_score"),
        (
            F.col("log_net") + F.col("log_rest") + zero("log_tail") - F.col("rest") * float(np.log10(rest))
        ).alias("score"),
    )
