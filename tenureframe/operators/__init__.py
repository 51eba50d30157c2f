"""Generic DataFrame operators over keyed interval histories."""

from tenureframe.operators.changes import (
    detect_changes,
    first_last_in_period,
    with_neighbour,
)
from tenureframe.operators.groups import pivot_values, share_within_group
from tenureframe.operators.intervals import active_at, join_as_of_interval, join_distinct
from tenureframe.operators.latest import dedupe_by_key, latest_per_key, max_date_rows
from tenureframe.operators.selection import values_at
from tenureframe.operators.skew import collapse, range_of, split_rows

__all__ = [
    "active_at",
    "collapse",
    "dedupe_by_key",
    "detect_changes",
    "first_last_in_period",
    "join_as_of_interval",
    "join_distinct",
    "latest_per_key",
    "max_date_rows",
    "pivot_values",
    "range_of",
    "share_within_group",
    "split_rows",
    "values_at",
    "with_neighbour",
]
