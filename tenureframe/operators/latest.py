"""Best row per key.

All three filter a ranking window on a small rank, which Spark turns into a
group limit before and after the shuffle: each map task sends at most ``n`` rows
(plus ties for ``max_date_rows``) per key, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _descending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1
) -> DataFrame:
    """The ``n`` rows per key that are highest by ``order``, NULL last.

    ``order`` must identify a row within its key, or the choice is left to Spark.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*_descending(order)))
    )
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def max_date_rows(df: DataFrame, keys: Sequence[str], date: str = "from_date") -> DataFrame:
    """Every row that carries the latest date of its key, ties kept."""
    ranked = df.filter(F.col(date).isNotNull()).withColumn(
        "_rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.col(date).desc()))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ("from_date", "rec_id")
) -> DataFrame:
    """One row per key: highest by ``prefer``, then by the other columns in order.

    Columns of ``prefer`` that the table lacks are passed over. NULL keys count
    as equal.
    """
    first = [c for c in prefer if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    return latest_per_key(df, keys, first + rest or list(keys))
