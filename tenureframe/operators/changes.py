"""Neighbouring rows and changes within a key's history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.functions import as_date, between_dates
from tenureframe.functions.dates import DateLike
from tenureframe.operators.latest import latest_per_key
from tenureframe.operators.skew import range_count, split_rows, with_range


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _same(columns: Sequence[str]) -> Column:
    return reduce(
        Column.__and__, [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in columns]
    )


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Mapping[str, str],
    direction: str = "previous",
    ranges_from: DataFrame | None = None,
) -> DataFrame:
    """Add columns from the previous (or next) row of the same key.

    ``take`` maps new column to source column. ``order`` must identify a row within
    its key.

    All rows are cut into ranges by key and order, and each range is sorted on its own, so
    neither a key nor a day of a key has to lie in one task. Ranges are cut at rows of the
    table itself: each such row ends its range (or begins it, when looking forward), and so
    is the one neighbour that the next (former) range has to know. What is carried over a
    boundary is therefore known before anything is sorted, and rows are shuffled once.
    ``ranges_from`` is a subset of the rows of ``df`` to choose the cuts from, if ``df`` is
    costly.
    """
    backwards = {"previous": True, "next": False}[direction]
    place = [*keys, *order]
    known = list(dict.fromkeys([*keys, *take.values()]))
    ranges = range_count(df)
    splits = split_rows(df if ranges_from is None else ranges_from, place, known, ranges)
    given = df.withColumn("_splits", splits)
    cut = with_range(given, "_range", "_splits", place, not backwards, ranges).drop("_splits")
    in_range = Window.partitionBy("_range").orderBy(*_ascending(place))
    step = F.lag if backwards else F.lead
    edge = F.get(splits, F.col("_range") - 1 if backwards else F.col("_range"))["carried"]
    near = F.coalesce(step(F.struct(*known)).over(in_range), edge)
    same_key = reduce(Column.__and__, [F.col(f"_near.{k}").eqNullSafe(F.col(k)) for k in keys])
    return (
        cut.withColumn("_near", near)
        .select(
            *df.columns,
            *[F.when(same_key, F.col(f"_near.{src}")).alias(out) for out, src in take.items()],
        )
    )


def detect_changes(
    history: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    start: DateLike | None = None,
    end: DateLike | None = None,
    only_different: bool = True,
    look_back: str = "full",
    also_previous: Sequence[str] = (),
    before: DataFrame | None = None,
) -> DataFrame:
    """Rows whose previous row of the same key has a value, added as ``prev_<value>``.

    Rows with an equal previous value go out when ``only_different``. With
    ``start`` and ``end`` the rows of that period (by ``order[0]``) are returned.
    ``look_back="full"`` finds a previous row before the period as well,
    ``"period"`` only inside it. ``also_previous`` names further columns whose
    previous value is added.

    A look back needs just the last row before the period, and only of keys with a row
    in the period: earlier history is cut to those inside the map tasks, and rows
    after the period are never read. ``before`` gives those last rows, at most one per key,
    in the columns of ``history``; earlier history is then not read at all.
    """
    if look_back not in ("full", "period"):
        raise ValueError(f"look_back must be 'full' or 'period', not {look_back!r}")
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    date, previous = order[0], f"prev_{value}"
    bounded = start is not None

    def in_period(df: DataFrame) -> DataFrame:
        return df.filter(between_dates(date, start, end)) if bounded else df

    needed = in_period(history)
    if bounded and look_back == "full":
        earlier = before
        if before is None:
            earlier = history.filter((F.col(date) < as_date(start)) | F.col(date).isNull())
        present = needed.select(*keys).distinct()
        wanted = earlier.alias("r").join(present.alias("c"), _same(keys), "left_semi")
        if before is None:
            wanted = latest_per_key(wanted, keys, order)
        needed = wanted.unionByName(needed)
    take = {f"prev_{c}": c for c in (value, *also_previous)}
    linked = with_neighbour(needed, keys, order, take, ranges_from=in_period(history))
    changed = in_period(linked).filter(F.col(previous).isNotNull())
    if only_different:
        changed = changed.filter(F.col(value) != F.col(previous))
    return changed


def first_last_in_period(
    history: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    start: DateLike,
    end: DateLike,
    only_different: bool = True,
) -> DataFrame:
    """Per key the first and last value of the period, and the date of the first."""
    position = F.struct(*order)
    ends = (
        history.filter(between_dates(order[0], start, end))
        .groupBy(*keys)
        .agg(
            F.min_by(value, position).alias(f"old_{value}"),
            F.max_by(value, position).alias(f"new_{value}"),
            F.min(order[0]).alias("change_date"),
        )
    )
    if only_different:
        ends = ends.filter(F.col(f"old_{value}") != F.col(f"new_{value}"))
    return ends
