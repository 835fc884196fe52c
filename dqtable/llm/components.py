"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqtable.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour (itself included) to its larger neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), "m")
    return linked.unionAll(least).select("a", F.col("m").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(a, b) long pairs -> (node, root): the smallest node that each linked node reaches.

    Every round writes its edges, so a lost executor repeats one round at most; no neighbourhood is
    gathered in one row, and the joins are plain ones that adaptive execution can split. An empty
    table, loops (a = b), repeated and reversed pairs are fine; pairs with a null are ignored.
    """
    edges = stored(edges.where("a <> b").select("a", "b"), f"{folder}/edges-0")
    before, step = None, 0
    while True:
        step += 1
        edges = stored(_small_star(_large_star(edges)), f"{folder}/edges-{step}")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
