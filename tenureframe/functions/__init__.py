"""Column expressions shared by the operators and reports."""

from tenureframe.functions.dates import (
    OPEN_END,
    as_date,
    between_dates,
    close_end,
    interval_days,
    interval_years,
    is_open,
    previous_month_range,
    to_day,
)
from tenureframe.functions.numbers import ratio, round_half_up, row_count

__all__ = [
    "OPEN_END",
    "as_date",
    "between_dates",
    "close_end",
    "interval_days",
    "interval_years",
    "is_open",
    "previous_month_range",
    "ratio",
    "round_half_up",
    "row_count",
    "to_day",
]
