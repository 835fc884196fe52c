"""Byte-level BPE: encode whole texts to the ids of a rank file, and decode ids to bytes.

Long texts are cut into overlapping chunks that are pre-tokenised apart. A chunk starts somewhere
within a pre-token, so its first boundaries may be wrong; where a boundary coincides with one of
the chunk before, both agree from there on, as a match depends only on what follows its start. The
text is cut at those places, and the pieces are encoded apart. Where two chunks agree nowhere in
their overlap (a run of thousands of letters or blanks), they form one piece, which is pre-tokenised
again as a whole: if it has no boundary where it ends, it is joined with the next piece, and so on.

Rows: one per row of `docs`. A null text is an empty one and has no tokens. Repeated rows and equal
or null doc_ids are kept apart by a row number. Special tokens in a text are ordinary text. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqtable.llm.common import fill, stored, with_columns, work_folder

RANKS = "byte_bpe_50k.tiktoken"
#: Code points per chunk, and how far a chunk reaches into the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: Code points before a chunk's end where boundaries could be others if the text went on.
MARGIN = 8
#: Blank runs from here on are too long for the tokenizer's own pattern matcher.
_BLANKS = re.compile(r"\s{20000}")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line, a token in base64 and its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding(
            "corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.pattern = regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}
        self.decimal = {i: str(i) for i in self.token}

    def encode(self, text: str) -> list[int]:
        if len(text) > CHUNK and _BLANKS.search(text):
            parts = (m.group().encode() for m in self.pattern.finditer(text))
            return [i for p in parts for i in self.encoding._encode_single_piece(p)]
        return self.encoding.encode_ordinary(text)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def digests(self, ids) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids, SHA-256 of the bytes they decode to."""
        numbers = " ".join(map(self.decimal.__getitem__, ids)).encode()
        decoded = hashlib.sha256(self.decode(ids)).hexdigest()
        return len(ids), hashlib.sha256(numbers).hexdigest(), decoded


def boundaries(codec: Codec, text: str, last: bool) -> tuple[list[int], list[int]]:
    """Ends of pre-tokens among the first OVERLAP code points, and behind CHUNK (from there).

    Not those behind a blank: how a run of blanks is split depends on what follows it, so a piece that
    ended in one would be split otherwise on its own.
    """
    found = (m.end() for m in codec.pattern.finditer(text))
    ends = np.fromiter((e for e in found if not text[e - 1].isspace()), np.int64)
    sure = ends if last else ends[ends <= len(text) - MARGIN]
    return sure[sure <= OVERLAP].tolist(), (sure[sure >= CHUNK] - CHUNK).tolist()


def _tokenized(rows: DataFrame, sent, pattern: str, carry: list[str], ids: bool) -> DataFrame:
    """Texts that are pieces on their own: digests, or their ids."""
    added = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    added = added + [("ids", pa.list_(pa.int32()))] * ids
    sql = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    schema = with_columns(rows.select(*carry), sql)

    def run(batches):
        codec = Codec(sent.value, pattern)
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in carry]
            texts = batch.column(batch.schema.get_field_index("text"))
            for start in range(0, len(texts), 256):
                part = [codec.encode(t) for t in texts.slice(start, 256).to_pylist()]
                found = [codec.digests(x) for x in part]
                columns = [batch.column(i).slice(start, 256) for i in at]
                values = [*zip(*found, strict=True), part]
                columns += [pa.array(v, t) for v, (_, t) in zip(values, added, strict=False)]
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, *(n for n, _ in added)])

    return rows.select(*carry, "text").mapInArrow(run, schema)


def _chunks(rows: DataFrame) -> DataFrame:
    """Long texts as rows of overlapping chunks; `no` counts them, `last` marks the last one."""
    count = F.ceil(F.length("text") / CHUNK).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(F.col("text"), i * CHUNK + 1, F.lit(CHUNK + OVERLAP)),
    )
    rows = rows.select("uid", count.alias("count"), F.posexplode(parts).alias("no", "text"))
    return rows.select("uid", "no", "text", (F.col("no") == F.col("count") - 1).alias("last"))


def _pieces(chunks: DataFrame, sent, pattern: str) -> DataFrame:
    """(uid, piece, several, text): the texts cut where neighbouring chunks agree. A piece of
    several chunks need not end at a boundary, as its chunks may have been wrong together."""
    schema = with_columns(chunks, "head array<long>, tail array<long>")

    def run(batches):
        codec = Codec(sent.value, pattern)
        kind = pa.list_(pa.int64())
        for batch in batches:
            text, last = batch.column("text").to_pylist(), batch.column("last").to_pylist()
            found = [boundaries(codec, t, x) for t, x in zip(text, last, strict=True)]
            more = [pa.array([f[k] for f in found], kind) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    order = Window.partitionBy("uid").orderBy("no")
    rows = chunks.mapInArrow(run, schema)
    meet = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    rows = rows.withColumn("cut", F.when(F.col("no") == 0, F.lit(0)).otherwise(meet))
    sofar = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("next", F.lead("cut").over(order))
    rows = rows.withColumn("piece", F.max(F.when(F.col("cut").isNotNull(), F.col("no"))).over(sofar))
    start = F.coalesce("cut", F.lit(0))
    stop = F.when(F.col("last"), F.length("text")).otherwise(
        F.coalesce(CHUNK + F.col("next"), F.lit(CHUNK))
    )
    own = F.col("text").substr((start + 1).cast("int"), (stop - start).cast("int"))
    return _joined(rows.select("uid", "piece", "no", own.alias("part")))


def _joined(parts: DataFrame) -> DataFrame:
    """(uid, piece, several, text) from parts (uid, piece, no, part)."""
    whole = F.array_sort(F.collect_list(F.struct("no", "part")))
    joined = parts.groupBy("uid", "piece").agg(whole.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["part"]), "")
    return joined.select("uid", "piece", (F.size("parts") > 1).alias("several"), text.alias("text"))


def _verified(pieces: DataFrame, sent, pattern: str, folder: str) -> DataFrame:
    """Pieces that all end at boundaries of their text; the first one begins at one.

    A piece of one chunk does: it begins where a scan that was right agrees with its own. Others are
    scanned with the beginning of what follows, and joined with the next piece if they do not. Each
    round has fewer pieces, and the first finds nothing to do where no run is that long.
    """

    def run(batches):
        codec = Codec(sent.value, pattern)
        for batch in batches:
            wrong = []
            columns = (batch.column(c).to_pylist() for c in ("text", "head", "last"))
            for text, head, last in zip(*columns, strict=True):
                seen = last or len(head) > MARGIN
                ends = (m.end() for m in codec.pattern.finditer(text + head))
                wrong.append(not (seen and any(e == len(text) for e in ends)))
            picked = [batch.column(c).filter(pa.array(wrong)) for c in ("uid", "next")]
            yield pa.RecordBatch.from_arrays(picked, names=["uid", "piece"])

    step = 0
    while True:
        order = Window.partitionBy("uid").orderBy("piece")
        keys = pieces.select("uid", "piece", "several").withColumn("next", F.lead("piece").over(order))
        unsure = keys.where("several and next is not null").select("uid", "piece", "next")
        if unsure.isEmpty():
            return pieces
        short = F.length("text") <= OVERLAP
        heads = pieces.select("uid", F.col("piece").alias("next"), F.left("text", F.lit(OVERLAP)).alias("head"), short.alias("short"))
        ends = pieces.groupBy("uid").agg(F.max("piece").alias("end"))
        asked = pieces.join(unsure, ["uid", "piece"]).join(heads, ["uid", "next"]).join(ends, "uid")
        asked = asked.withColumn("last", F.col("short") & (F.col("next") == F.col("end")))
        wrong = asked.select("uid", "next", "text", "head", "last").mapInArrow(run, "uid long, piece int")
        wrong = stored(wrong, f"{folder}/wrong-{step}")
        if wrong.isEmpty():
            return pieces
        begins = keys.join(wrong.withColumn("wrong", F.lit(True)), ["uid", "piece"], "left")
        into = F.max(F.when(F.col("wrong").isNull(), F.col("piece"))).over(
            order.rowsBetween(Window.unboundedPreceding, 0)
        )
        into = begins.select("uid", "piece", into.alias("into"), "several")
        parts = pieces.drop("several").join(into, ["uid", "piece"])
        merged = _joined(parts.select("uid", F.col("into").alias("piece"), F.col("piece").alias("no"), F.col("text").alias("part")))
        again = into.groupBy("uid", F.col("into").alias("piece")).agg(F.max("several").alias("before"))
        merged = merged.join(again, ["uid", "piece"])
        step += 1
        several = (F.col("several") | F.col("before")).alias("several")
        pieces = stored(merged.select("uid", "piece", several, "text"), f"{folder}/pieces-{step}")


def encoded(
    docs: DataFrame,
    ranks: str = "",
    pattern: str = public_tokenizers.PATTERN,
    ids: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256 and, on demand, ids) per row.

    Texts of one chunk stay in the task that read them; only longer ones are shuffled, by chunk and
    then by piece, so that no task encodes a long text alone.
    """
    spark = docs.sparkSession
    vocabulary = read_ranks(ranks or public_tokenizers.path(RANKS))
    sent = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select("doc_id", fill().alias("text"))
    short = rows.where(F.length("text") <= CHUNK)
    results = _tokenized(short, sent, pattern, ["doc_id"], ids)
    # numbered before the filter, as both uses must agree on the number
    long = rows.withColumn("uid", F.monotonically_increasing_id()).where(F.length("text") > CHUNK)
    folder = work_folder(spark, "bpe")
    cut = stored(_pieces(_chunks(long), sent, pattern), f"{folder}/pieces-0")
    cut = _verified(cut, sent, pattern, folder).drop("several").repartition("uid", "piece")
    encoded_pieces = _tokenized(cut, sent, pattern, ["uid", "piece"], True)
    names = long.select("uid", "doc_id")
    tokens = encoded_pieces.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts")
    )
    tokens = tokens.select("uid", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
    whole = _digested(tokens.join(names, "uid"), sent, pattern, ids)
    return results.unionByName(whole)


def _digested(rows: DataFrame, sent, pattern: str, ids: bool) -> DataFrame:
    """Rows with the ids of a whole text, as `_tokenized` gives them."""
    sql = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    schema = with_columns(rows.select("doc_id"), sql)

    def run(batches):
        codec = Codec(sent.value, pattern)
        for batch in batches:
            tokens = batch.column("ids")
            found = [codec.digests(x) for x in tokens.to_pylist()]
            kinds = (pa.int64(), pa.string(), pa.string())
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)]
            columns = [batch.column("doc_id"), *columns, *[tokens] * ids]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select("doc_id", "ids").mapInArrow(run, schema)


def decoded(tokens: DataFrame, ranks: str = "") -> DataFrame:
    """`tokens` (doc_id, ids) -> (doc_id, text): the bytes of all ids, concatenated.

    A null list decodes to an empty text.
    """
    sent = tokens.sparkSession.sparkContext.broadcast(
        {i: t for t, i in read_ranks(ranks or public_tokenizers.path(RANKS)).items()}
    )
    schema = with_columns(tokens.select("doc_id"), "text string")

    def run(batches):
        for batch in batches:
            texts = [b"".join(map(sent.value.__getitem__, x or ())) for x in batch.column("ids").to_pylist()]
            text = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], names=schema.names)

    return tokens.select("doc_id", "ids").mapInArrow(run, schema)
