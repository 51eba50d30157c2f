"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round a double through a decimal, so that 1.005 is 1.01 on any engine."""
    return F.round(value.cast("decimal(18,6)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in doubles; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def row_count() -> Column:
    return F.count(F.lit(1))
