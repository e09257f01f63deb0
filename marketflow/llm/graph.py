"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step. Edges are (u, v) with u > v."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.unionAll(small.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots; a root is the smallest node it reaches.

    Every node's smallest neighbour is found by an aggregate that combines before the shuffle, no neighbourhood is gathered.
    Each round is written to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    current = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())

    before = state(current)
    for _ in range(rounds if before[0] else 0):
        current = stored(_stars(current), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
