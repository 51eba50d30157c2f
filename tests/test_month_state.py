"""Months from rolled states against reports over all history."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenureframe.plans import change_reports, jobs
from tenureframe.plans.month_state import MonthStates, roll_forward, state_from_scratch
from tenureframe.sinks import save_tables
from tenureframe.sources import read_parquet_tables, table_schema

D = dt.date
# The run starts with this month of 1996; 24 months take some minutes.
FIRST, MONTHS = 10, 5


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Twelve employees over five years, with ties on a day and rows without a date."""
    rng = random.Random(2)
    zone = str(tmp_path_factory.mktemp("zone"))

    def history(values, n):
        made = []
        for i in range(n):
            day = D(1995, 1, 1) + dt.timedelta(days=rng.randrange(5 * 365))
            made.append((rng.randrange(12), rng.choice(values), day if i % 40 else None, D(9999, 1, 1), i))
        return made

    tables = {
        "employees": [(e, D(1960, 1, 1), f"F{e}", f"L{e}", "M", D(1990, 1, 1)) for e in range(12)],
        "departments": [(f"d{i}", f"Department {i}") for i in range(4)],
        "dept_emp": [(e, v, a, b, i) for e, v, a, b, i in history([f"d{i}" for i in range(4)], 200)],
        "salaries": history([Decimal(f"{v}.50") for v in range(900, 905)], 300),
        "titles": history(["Staff", "Engineer", "Senior"], 200),
    }
    made = {
        name: spark.createDataFrame(data, table_schema(name, record_id=True)) for name, data in tables.items()
    }
    made["dept_manager"] = spark.createDataFrame([], table_schema("dept_manager", record_id=True))
    save_tables(made, zone)
    return read_parquet_tables(spark, zone, record_id=True)


@pytest.fixture
def one_task(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_months_in_a_row_equal_all_history(spark, small, tmp_path, one_task):
    """From states alone after the first month, over the end of a year."""
    base = str(tmp_path)
    found = []
    for month in range(MONTHS):
        run_date = D(1996 + (FIRST + month) // 12, (FIRST + month) % 12 + 1, 5)
        path = jobs.run_month_from_state(spark, small, run_date, base)
        report = jobs.read_report(spark, path, change_reports.VALUE_SCHEMA)
        found.append(report.withColumn("month", F.lit(month)))
    together = found[0]
    for report in found[1:]:
        together = together.unionByName(report)
    # A report over all months has the same rows as the months, each looking back fully.
    end = max(MonthStates(spark, base).ends())
    whole = change_reports.value_change_report(small, D(1996, FIRST, 1), end)
    assert rows(together.drop("month")) == rows(whole) and whole.count() > 10 * MONTHS
    assert together.select("month").distinct().count() == MONTHS
    states = MonthStates(spark, base)
    assert len(states.ends()) == MONTHS + 1 and min(states.ends()) == D(1996, FIRST - 1, 30)
    scratch = state_from_scratch(small, end)
    assert rows(states.read(end, scratch.schema)) == rows(scratch)


def test_a_month_run_again_and_a_month_left_out(spark, small, tmp_path, one_task):
    base = str(tmp_path)
    path = jobs.run_month_from_state(spark, small, D(1996, 3, 1), base)
    first = rows(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA))
    assert jobs.run_month_from_state(spark, small, D(1996, 3, 9), base) == path
    assert rows(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA)) == first != []
    # May after February: March and April are rolled over first.
    path = jobs.run_month_from_state(spark, small, D(1996, 6, 1), base)
    expected = change_reports.value_change_report(small, D(1996, 5, 1), D(1996, 5, 31))
    assert rows(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA)) == rows(expected)
    states = MonthStates(spark, base)
    rolled = states.read(D(1996, 4, 30), state_from_scratch(small, D(1996, 4, 30)).schema)
    assert rows(rolled) == rows(state_from_scratch(small, D(1996, 4, 30)))
    assert rows(states.rebuild(small, D(1996, 4, 30))) == rows(rolled)


def test_a_month_reads_its_rows_and_the_state_only(spark, small, tmp_path):
    """No scan of a history reaches before the month, whatever lies there."""
    start, end = D(1996, 2, 1), D(1996, 2, 29)
    state = MonthStates(spark, str(tmp_path)).rebuild(small, D(1996, 1, 31))
    plans = []
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for df in (
        change_reports.value_change_report(small, start, end, before=state),
        roll_forward(state, small, start, end),
    ):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for plan in plans:
        scans = [line for line in plan.splitlines() if "FileScan" in line and "from_date" in line]
        history = [line for line in scans if "/state/" not in line]
        assert history and all("GreaterThanOrEqual(from_date,1996-02-01)" in line for line in history)
