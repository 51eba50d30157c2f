"""Date expressions for rows valid from ``from_date`` to ``to_date``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date that marks a row as still valid.
OPEN_END = dt.date(9999, 1, 1)

# Fixed value: days in a year for every tenure figure.
DAYS_PER_YEAR = 365

DateLike = dt.date | str | Column


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_date(value: DateLike | None = None) -> Column:
    """A date given as a date, an ISO string or a column; ``None`` is today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def to_day(column: str | Column) -> Column:
    """Text, date or timestamp to a date; text that is no date becomes NULL."""
    return F.try_to_date(_column(column))


def between_dates(column: str | Column, start: DateLike, end: DateLike) -> Column:
    """Both edges included."""
    return _column(column).between(as_date(start), as_date(end))


def is_open(end: str | Column = "to_date") -> Column:
    return _column(end) == F.lit(OPEN_END)


def close_end(end: str | Column = "to_date", as_of: DateLike | None = None) -> Column:
    """The end date, with ``as_of`` in place of the open-end mark."""
    return F.when(is_open(end), as_date(as_of)).otherwise(_column(end))


def interval_days(
    start: str | Column = "from_date",
    end: str | Column = "to_date",
    as_of: DateLike | None = None,
) -> Column:
    """Days from start to end, an open interval counted up to ``as_of``."""
    return F.datediff(close_end(end, as_of), _column(start))


def interval_years(
    start: str | Column = "from_date",
    end: str | Column = "to_date",
    as_of: DateLike | None = None,
) -> Column:
    return interval_days(start, end, as_of) / F.lit(float(DAYS_PER_YEAR))


def previous_month_range(run_date: DateLike | None = None) -> tuple[Column, Column]:
    """First and last day of the month before ``run_date``."""
    month_start = F.trunc(as_date(run_date), "MM")
    return F.to_date(F.add_months(month_start, -1)), F.date_sub(month_start, 1)
