"""Shares within a group, and a pivot over known values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.functions import ratio, row_count


def share_within_group(
    df: DataFrame, group: str, category: str, weight: str | None = None, share: str = "share"
) -> DataFrame:
    """Rows per (group, category) and their percentage of the group's rows.

    ``weight`` names a column that holds how many rows a row stands for. The
    window runs on the counts, so its groups are as long as the category has
    values.
    """
    rows = row_count() if weight is None else F.sum(weight)
    counts = df.groupBy(group, category).agg(rows.alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(group))
    return counts.withColumn(share, ratio(F.col("rows") * 100.0, total))


def pivot_values(
    df: DataFrame, group: str, category: str, measure: str, values: Mapping[str, str]
) -> DataFrame:
    """One row per group and one column per value: ``{category value: column name}``."""
    cells = [
        F.max(F.when(F.col(category) == value, F.col(measure))).alias(name)
        for value, name in values.items()
    ]
    return df.groupBy(group).agg(*cells)
