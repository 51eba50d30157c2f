"""Connected components of an edge table, by alternating large and small stars.

Each round ties every node's larger neighbours, then its smaller ones, to its
smallest neighbour; the number of rounds grows with the logarithm of the longest
path. Every round is written to the shared folder and read back, so a lost executor
costs one round at most, and no node or edge reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("least").alias("v"))
        .filter("u <> v")
        .unionByName(least.select("u", F.col("least").alias("v")))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """One row (``node``, ``root``) per node of ``edges`` (``u``, ``v``) but the roots.

    The root is the smallest node that can be reached.
    """

    def state(df: DataFrame) -> tuple:
        mark = F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("decimal(38,0)"))
        return tuple(df.agg(row_count(), mark).first())

    edges = staged(edges.select("u", "v").filter("u <> v"), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = staged(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
