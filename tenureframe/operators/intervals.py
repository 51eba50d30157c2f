"""Filters and joins on validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    FractionalType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from tenureframe.functions import as_date, row_count
from tenureframe.functions.dates import DateLike
from tenureframe.operators.skew import collapse


def active_at(
    df: DataFrame, day: DateLike | None = None, start: str = "from_date", end: str = "to_date"
) -> DataFrame:
    """Rows valid on ``day``, both ends included; an open end lies after any day."""
    day = as_date(day)
    return df.filter((F.col(start) <= day) & (F.col(end) >= day))


def _check_types(facts: DataFrame, history: DataFrame, key: str, *dates: tuple) -> None:
    """Keys must be of one kind, dates must be dates: else equal values would not meet."""
    left, right = facts.schema[key].dataType, history.schema[key].dataType
    if left != right and not all(isinstance(t, NumericType) for t in (left, right)):
        raise TypeError(f"{key} is {left.simpleString()} on one side, {right.simpleString()} on the other")
    for df, column in dates:
        kind = df.schema[column].dataType
        if not isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
            raise TypeError(f"{column} must be a date or timestamp, not {kind.simpleString()}")


# Days of a node on each level; an interval lies in one or two nodes of the lowest level
# whose nodes are no shorter than it is.
NODE_DAYS = (2, 8, 32, 128, 512, 4096, 65_536, 4_194_304)

# A key with at most so many intervals is not cut into nodes. Whether a key is crowded is
# known by the bucket of its hash: the flags are of one size, however many keys there are.
CROWDED = 128
KEY_BUCKETS = 65_536


def _bucket(key: Column, left: DataType, right: DataType) -> Column:
    """The bucket of a key; keys that are equal in a join have the same one."""
    if left != right or isinstance(left, FractionalType):
        # Of two zeros that are equal, the sum is one value.
        key = key.cast("double") + F.lit(0.0)
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def _crowded_buckets(intervals: DataFrame, key: str, bucket: Column, most: int) -> Column:
    """For each bucket, whether a key in it has more than ``most`` rows: an array of flags, a
    subquery of the plan."""
    crowded = (
        intervals.groupBy(key)
        .agg(row_count().alias("_n"))
        .filter(F.col("_n") > most)
        .select(bucket.cast("long").alias("id"), F.lit(True).alias("crowded"))
    )
    every = intervals.sparkSession.range(KEY_BUCKETS).withColumn("crowded", F.lit(False))
    flags = every.unionByName(crowded).filter("id IS NOT NULL")
    flags = flags.groupBy("id").agg(F.max("crowded").alias("crowded"))
    return flags.agg(F.array_sort(F.collect_list(F.struct("id", "crowded")))["crowded"]).scalar()


def _day(column: str) -> Column:
    return F.unix_date(F.to_date(F.col(column)))


def _of_fact(day: Column) -> Column:
    """The nodes that a day lies in, one on each level."""
    return F.array(*[
        F.struct(F.lit(days).alias("_days"), F.floor(day / days).alias("_node")) for days in NODE_DAYS
    ])


def _level_of(length: Column) -> Column:
    """Days of the nodes on the level of intervals of so many days."""
    level = F.lit(NODE_DAYS[-1])
    for days in reversed(NODE_DAYS[:-1]):
        level = F.when(length <= days, days).otherwise(level)
    return level


def join_as_of_interval(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    date: str,
    closed: str = "both",
    start: str = "from_date",
    end: str = "to_date",
    sizes_from: DataFrame | None = None,
    crowded: int = CROWDED,
) -> DataFrame:
    """Join each fact to the history rows of its key that cover the fact's date.

    ``closed="both"`` includes both ends, so a date on which one row ends and the
    next begins matches both; ``"left"`` excludes the end. Apart from ``key`` the
    two sides must not share column names. The result has a row per matching pair;
    where only counts or sums are needed, ``join_distinct`` is far smaller.

    A key with at most ``crowded`` intervals is one node: its rows are shuffled once each, and
    a fact meets at most so many intervals. For other keys, and those that share the bucket
    of their hash, days are cut into nodes of 2, 8, 32, ... days. An interval goes to the one
    or two nodes it lies in on the level of its length, a fact to its node on every level,
    and rows meet on key and node: neither side grows with the days that intervals or keys
    cover. Nodes are at most a few times as long as the intervals in them, so most pairs that
    meet are in the result, and the dates decide on the others. A key spreads over its nodes,
    and adaptive execution divides the rows of a crowded one.

    Intervals per key are counted in ``sizes_from``, if ``history`` is costly to read twice: a
    table with the same key and at least as many rows of each.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    _check_types(facts, history, key, (facts, date), (history, start), (history, end))
    bucket = _bucket(F.col(key), facts.schema[key].dataType, history.schema[key].dataType)
    sizes = history if sizes_from is None else sizes_from
    flags = _crowded_buckets(sizes, key, bucket, crowded)
    in_nodes = F.coalesce(F.get(flags, bucket), F.lit(False))
    nodes = F.sequence(
        F.floor(F.col("_first") / F.col("_days")), F.floor(F.col("_last") / F.col("_days"))
    )
    one = F.lit(0).cast("long")
    pieces = (
        history.withColumns({"_first": _day(start), "_last": _day(end), "_in_nodes": in_nodes})
        .filter("_first <= _last")
        .withColumn("_days", _level_of(F.col("_last") - F.col("_first") + 1))
        .withColumn("_node", F.explode(F.when(F.col("_in_nodes"), nodes).otherwise(F.array(one))))
        .withColumn("_days", F.when(F.col("_in_nodes"), F.col("_days")).otherwise(0))
    )
    whole = F.array(F.struct(F.lit(0).alias("_days"), one.alias("_node")))
    placed = facts.filter(F.col(date).isNotNull()).select(
        *facts.columns, F.inline(F.when(in_nodes, _of_fact(_day(date))).otherwise(whole))
    )
    before_end = F.col(date) <= F.col(end) if closed == "both" else F.col(date) < F.col(end)
    joined = placed.alias("l").join(
        pieces.alias("r"),
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (F.col("l._days") == F.col("r._days"))
        & (F.col("l._node") == F.col("r._node"))
        & (F.col(date) >= F.col(start))
        & before_end,
    )
    return joined.select(
        *[F.col(f"l.{c}") for c in facts.columns],
        *[F.col(f"r.{c}") for c in history.columns if c != key],
    )


def join_distinct(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    date: str,
    closed: str = "both",
    start: str = "from_date",
    end: str = "to_date",
    count: str = "n",
) -> DataFrame:
    """The same join over distinct rows, with the number of pairs each result stands for.

    Both sides shrink inside the map tasks, so a key with very many equal rows gives
    its distinct combinations instead of all its pairs.
    """
    left = collapse(facts, facts.columns, count="_facts")
    right = collapse(history, history.columns, count="_rows")
    joined = join_as_of_interval(left, right, key, date, closed, start, end)
    return joined.withColumn(count, F.col("_facts") * F.col("_rows")).drop("_facts", "_rows")
