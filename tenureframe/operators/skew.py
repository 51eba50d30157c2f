"""Shrink and spread keys that may hold very many rows.

Nothing here looks at the data while a plan is built, and nothing switches on its
size: the same plan runs at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureframe.functions import row_count

# Ranges for each shuffle partition, so that their sizes even out, and at most.
RANGES_A_PARTITION = 16
MOST_RANGES = 4096


def range_count(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_RANGES, RANGES_A_PARTITION * partitions)


def split_rows(
    source: DataFrame, order: Sequence[str], take: Sequence[str], ranges: int
) -> Column:
    """Rows of ``source`` that cut it into about even ranges by ``order``: a sorted array
    of (``at``: the columns of ``order``, ``carried``: those of ``take``).

    The rows are those with the lowest hashes, a sample in which every row counts alike,
    whatever the types of its columns. The array is a subquery of the plan: a scan that
    keeps so many rows in each task, and no shuffle.
    """
    sample = (
        source.select(F.struct(*order).alias("at"), F.struct(*take).alias("carried"))
        .orderBy(F.xxhash64("at"))
        .limit(max(1, ranges - 1))
    )
    return sample.agg(F.array_sort(F.collect_list(F.struct("at", "carried")))).scalar()


def range_of(splits: str, order: Sequence[str], with_split: bool, ranges: int) -> Column:
    """The expression of ``with_range`` on its own, for arrays and their elements. How many rows of the array ``splits``, which cuts into at most ``ranges``, lie before a
    row, by binary search; a row that is itself in the array counts only if ``with_split``."""
    array, here = F.col(splits), F.struct(*order)
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(ranges.bit_length()))])

    def step(found: Column, by: Column) -> Column:
        at = F.get(array, found + by - 1)["at"]
        before = at <= here if with_split else at < here
        return found + F.when(before, by).otherwise(0)

    return F.aggregate(steps, F.lit(0), step)


def with_range(
    df: DataFrame, name: str, splits: str, order: Sequence[str], with_split: bool, ranges: int
) -> DataFrame:
    """Add how many rows of the array ``splits``, a column of ``df`` which cuts into at most
    ``ranges``, lie before a row; a row that is itself in the array counts only if ``with_split``.

    A binary search with a projection for each step, so that all of it is compiled: a
    function over the steps would be interpreted, struct by struct, for every row.
    """
    here = F.struct(*order)
    found = df.withColumn(name, F.lit(0))
    for bit in reversed(range(ranges.bit_length())):
        step = 1 << bit
        at = F.get(F.col(splits), F.col(name) + (step - 1))["at"]
        before = at <= here if with_split else at < here
        found = found.withColumn(name, F.col(name) + F.when(before, step).otherwise(0))
    return found


def collapse(
    df: DataFrame, by: Sequence[str], sums: Sequence[str] = (), count: str = "n"
) -> DataFrame:
    """One row per distinct ``by``, with sums and the number of rows it stands for.

    Use it before a join whose result is only summed: partial aggregation shrinks a
    key inside every map task, and what is left is bounded by the distinct values of
    ``by``.
    """
    return df.groupBy(*by).agg(*[F.sum(s).alias(s) for s in sums], row_count().alias(count))
