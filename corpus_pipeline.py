"""Corpus pipeline: rules, near-duplicates, benchmark passages, personal data, tokens.

Each stage reads what the one before wrote and returns the columns of `documents`; the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqtable.llm.byte_bpe import encoded
from dqtable.llm.common import read_table, stored, work_folder
from dqtable.llm.decontaminate import drop_contaminated
from dqtable.llm.pii import redact
from dqtable.llm.quality import keep_good
from dqtable.llm.simhash_dedup import drop_near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data is replaced by its kind."""
    return redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    return encoded(docs, ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("byte_bpe", byte_bpe),
]

#: Covariance estimates, fingerprints and merges have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs
