"""Token counts with a digest cache.

A count depends on the text and the tokenizer alone, so it is stored under the digests of both.
Texts are looked up by digest; only distinct texts that the cache lacks are tokenised, and their
counts are appended to it. The one normalisation that leaves every count as it is: null is empty.

Rows: one per row of `docs`; repeated rows and null doc_ids keep theirs. Copies of a text, and runs
that race for the same cache, may store a count twice; a look-up takes one of the equal values.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqtable.llm.common import fill, work_folder

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
_CACHE = "tokenizer string, content binary, n_tokens long"


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _open_cache(spark: SparkSession, path: str) -> None:
    """Make sure that a cache is there, without touching what it holds."""
    spark.createDataFrame([], _CACHE).write.mode("append").partitionBy("tokenizer").parquet(path)


def cached(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) that the cache at `path` holds for a tokenizer digest."""
    rows = spark.read.schema(_CACHE).option("basePath", path).parquet(path)
    rows = rows.where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _counts(misses: DataFrame, model: bytes) -> DataFrame:
    sent = misses.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        pieces = sentencepiece.SentencePieceProcessor(model_proto=sent.value)
        for batch in batches:
            content, text = batch.column("content"), batch.column("text")
            for start in range(0, len(text), 64):
                ids = pieces.encode(text.slice(start, 64).to_pylist(), num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [content.slice(start, 64), pa.array([len(x) for x in ids], pa.int64())],
                    names=["content", "n_tokens"],
                )

    return misses.select("content", "text").mapInArrow(run, "content binary, n_tokens long")


def fill_cache(docs: DataFrame, path: str, model: bytes) -> str:
    """Append the counts of all texts that the cache lacks; returns the tokenizer's digest.

    Copies are merged in the map tasks before texts are shuffled, so a text that makes up a third
    of all rows reaches the reducer once per task.
    """
    spark = docs.sparkSession
    tokenizer = hashlib.sha256(model).hexdigest()
    _open_cache(spark, path)
    texts = docs.select(F.unhex(F.sha2(fill(), 256)).alias("content"), fill().alias("text"))
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(cached(spark, path, tokenizer), "content", "left_anti")
    counts = _counts(misses, model).withColumn("tokenizer", F.lit(tokenizer))
    counts.write.mode("append").partitionBy("tokenizer").parquet(path)
    return tokenizer


def token_counts(
    docs: DataFrame, cache: str = "", model: str = "", limit: int = LIMIT
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row, by way of the cache at `cache`.

    Without a path the cache is a new one, for this call. The model file is given by its path; it
    is sent to the tasks as it is, and beginning, end or other special tokens are not added.
    """
    spark = docs.sparkSession
    path = cache or work_folder(spark, "token-counts")
    tokenizer = fill_cache(docs, path, read_model(model or public_tokenizers.path(MODEL)))
    rows = docs.select(
        "doc_id",
        F.octet_length(fill()).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(fill(), 256)).alias("content"),
    )
    found = rows.join(cached(spark, path, tokenizer), "content")
    return found.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
