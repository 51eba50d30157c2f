import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenureframe.functions import (
    as_date,
    close_end,
    interval_days,
    interval_years,
    previous_month_range,
    ratio,
    round_half_up,
    to_day,
)
from tenureframe.plans.jobs import month_before

D = dt.date


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("run_date", "first", "last"),
    [
        (D(2025, 1, 15), D(2024, 12, 1), D(2024, 12, 31)),
        (D(2024, 3, 1), D(2024, 2, 1), D(2024, 2, 29)),
        (D(2025, 3, 31), D(2025, 2, 1), D(2025, 2, 28)),
    ],
)
def test_previous_month(spark, run_date, first, last):
    columns = previous_month_range(run_date)
    assert tuple(spark.range(1).select(*columns).first()) == (first, last)
    assert month_before(run_date) == (first, last)


def test_text_that_is_no_date_becomes_null(spark):
    df = spark.createDataFrame([("1999-05-06",), ("tomorrow",), (None,)], "d string")
    assert [r[0] for r in df.select(to_day("d")).collect()] == [D(1999, 5, 6), None, None]


def test_timestamps_become_dates(spark):
    assert one(spark, to_day(F.lit("1999-05-06 10:11:12").cast("timestamp_ntz"))) == D(1999, 5, 6)


def test_open_end_counts_to_as_of(spark):
    start, open_end = as_date("2000-01-01"), as_date("9999-01-01")
    assert one(spark, interval_days(start, open_end, D(2001, 1, 1))) == 366
    assert one(spark, interval_days(start, as_date("2000-01-11"), D(2001, 1, 1))) == 10
    assert one(spark, interval_years(start, as_date("2000-12-31"), None)) == 1.0
    assert one(spark, close_end(open_end, "2001-01-01")) == D(2001, 1, 1)
    assert one(spark, close_end(F.lit(None).cast("date"), "2001-01-01")) is None


def test_default_is_today(spark):
    today = one(spark, F.current_date())
    assert one(spark, as_date()) == today


def test_rounding_goes_up_at_half(spark):
    assert one(spark, round_half_up(F.lit(1.005))) == 1.01
    assert one(spark, round_half_up(F.lit(-1.005))) == -1.01


def test_division_by_zero_is_null(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(1), F.lit(4))) == 0.25
