"""Every operator and report over the HR tables derived from the test data.

A query takes (spark, sf_dir) and returns a DataFrame whose columns have types
that both engines print alike: text, bigint, double, boolean.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, IntegerType

from tenureframe import operators as op
from tenureframe.functions import (
    interval_years,
    previous_month_range,
    round_half_up,
    row_count,
)
from tenureframe.plans import analytics, change_reports, cleaning, jobs, quality
from tenureframe.plans.recleaning import CleanedZone
from tenureframe.session import scratch_path
from tenureframe.sinks import (
    publish_tables,
    run_stamped_path,
    sample_rows,
    write_csv_report,
    write_parquet_report,
)
from tenureframe.sources import period_rows, read_parquet_tables
from tenureframe.sources.orders_binding import faulty_hr_tables, hr_tables

AS_OF = dt.date(2001, 12, 31)
PERIOD = (dt.date(1996, 1, 1), dt.date(1997, 12, 31))
RUN_DATE = dt.date(1997, 3, 15)
MONTH = (dt.date(1997, 2, 1), dt.date(1997, 2, 28))
MID_DAY = dt.date(1998, 6, 30)
RUN_TIME = dt.datetime(2001, 12, 31, 3, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text, decimals as doubles, integers as bigint, arrays joined."""

    def plain(field):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, DateType):
            column = column.cast("string")
        elif isinstance(kind, DecimalType):
            column = column.cast("double")
        elif isinstance(kind, IntegerType):
            column = column.cast("bigint")
        elif isinstance(kind, ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def _watched_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules, counted while the tables are published."""
    path = scratch_path(spark, "watched")
    manifest = publish_tables(faulty_hr_tables(spark, sf_dir), path, watch=quality.watch_rules)
    return quality.checks_of(spark, manifest)


def _over(tables, plan) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(plan(tables(spark, sf_dir)))

    return run


def _hr(plan) -> Query:
    return _over(hr_tables, plan)


def _faulty(plan) -> Query:
    return _over(faulty_hr_tables, plan)


_saved: dict[tuple[str, str], str] = {}


def _cleaned_tables(spark: SparkSession, sf_dir: str):
    """The cleaned zone: published once per session, as the reports expect it."""
    where = (spark.sparkContext.applicationId, sf_dir)
    if where not in _saved:
        path = scratch_path(spark, "cleaned")
        publish_tables(cleaning.clean_all_tables(faulty_hr_tables(spark, sf_dir), AS_OF), path)
        _saved[where] = path
    return read_parquet_tables(spark, _saved[where], record_id=True)


def _cleaned(plan) -> Query:
    return _over(_cleaned_tables, plan)


def _bucketed_tables(spark: SparkSession, sf_dir: str):
    """The cleaned zone in buckets of employee numbers."""
    where = (spark.sparkContext.applicationId, f"buckets of {sf_dir}")
    if where not in _saved:
        path = scratch_path(spark, "buckets")
        cleaned = cleaning.clean_all_tables(faulty_hr_tables(spark, sf_dir), AS_OF)
        publish_tables(cleaned, path, buckets=8)
        _saved[where] = path
    return read_parquet_tables(spark, _saved[where], record_id=True)


def _bucketed(plan) -> Query:
    return _over(_bucketed_tables, plan)


def _recleaned(table: str) -> Query:
    """A zone of older sources, whose employees of some numbers came later, brought up to
    date with the present ones."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = faulty_hr_tables(spark, sf_dir)
        older = {
            name: df.filter(F.col("emp_no") % 50 != 7) if "emp_no" in df.columns else df
            for name, df in tables.items()
        }
        zone = CleanedZone(spark, scratch_path(spark, "recleaned"), buckets=64)
        zone.update(older)
        zone.update(tables)
        return comparable(zone.read(AS_OF)[table])

    return run


def _row_counts(tables) -> DataFrame:
    out = None
    for name, df in tables.items():
        counted = df.agg(row_count().alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        out = counted if out is None else out.unionByName(counted)
    return out


# Sources and sinks


def _saved_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_cleaned_tables(spark, sf_dir)["salaries"])


def _saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = analytics.annual_cost(hr_tables(spark, sf_dir), AS_OF)
    write_parquet_report(report, path)
    return comparable(spark.read.schema(report.schema).parquet(path))


def _csv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "change-log")
    log = change_reports.change_log(hr_tables(spark, sf_dir), *PERIOD)
    write_csv_report(log, path)
    return comparable(jobs.read_report(spark, path, log.schema))


def _csv_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = hr_tables(spark, sf_dir)
    base = scratch_path(spark, "runs")
    path = jobs.run_latest_changes(tables, *PERIOD, base, RUN_TIME)
    assert path == run_stamped_path(base, RUN_TIME)
    schema = change_reports.LATEST_SCHEMA
    return comparable(jobs.read_report(spark, path, schema))


def _csv_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = hr_tables(spark, sf_dir)
    path = jobs.run_monthly_changes(tables, RUN_DATE, scratch_path(spark, "months"))
    schema = change_reports.VALUE_SCHEMA
    return comparable(jobs.read_report(spark, path, schema))


def _month_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months in a row: the second one starts from the state that the first one leaves."""
    tables, base = hr_tables(spark, sf_dir), scratch_path(spark, "states")
    month = jobs.month_before(RUN_DATE)[0]
    jobs.run_month_from_state(spark, tables, month, base)
    path = jobs.run_month_from_state(spark, tables, RUN_DATE, base)
    return comparable(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the written log."""
    path = scratch_path(spark, "change-log")
    log = change_reports.change_log(hr_tables(spark, sf_dir), *PERIOD)
    write_parquet_report(log, path)
    return comparable(change_reports.change_summary(spark.read.schema(log.schema).parquet(path)))


# Generic operators


def _title_at_pay(closed: str):
    def plan(t):
        pay = t["salaries"].select("emp_no", "salary", F.col("from_date").alias("pay_date"))
        held = t["titles"].select("emp_no", "title", "from_date", "to_date")
        return op.join_as_of_interval(pay, held, "emp_no", "pay_date", closed)

    return plan


def _distinct_titles_at_pay(t) -> DataFrame:
    pay = t["salaries"].select("emp_no", F.col("from_date").alias("pay_date"))
    held = t["titles"].select("emp_no", "title", "from_date", "to_date")
    return op.join_distinct(pay, held, "emp_no", "pay_date")


def _open_stays(t) -> DataFrame:
    return analytics.open_stays_by_gender(t)


def _pivot(t) -> DataFrame:
    shares = op.share_within_group(_open_stays(t), "dept_name", "gender", weight="stays")
    return op.pivot_values(shares, "dept_name", "gender", "rows", {"M": "men", "F": "women"})


def _shares(t) -> DataFrame:
    shares = op.share_within_group(_open_stays(t), "dept_name", "gender", weight="stays")
    return shares.withColumn("share", round_half_up(F.col("share")))


def _month_before_hire(t) -> DataFrame:
    first, last = previous_month_range(F.col("hire_date"))
    return t["employees"].select(
        "emp_no", "hire_date", first.alias("first_day"), last.alias("last_day")
    )


def _interval_checks(t) -> DataFrame:
    checks = [
        quality.check_intervals(t[name], name)
        for name in ("dept_emp", "dept_manager", "salaries", "titles")
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2]).unionByName(checks[3])


def _null_reports(t) -> DataFrame:
    out = None
    for name, df in t.items():
        report = quality.check_nulls(df, name)
        out = report if out is None else out.unionByName(report)
    return out


def _profile(t) -> DataFrame:
    profile = quality.profile_out_of_range(t["salaries"], "salary", *cleaning.SALARY_RANGE)
    return profile.withColumns(
        {c: round_half_up(F.col(c)) for c in ("mean", "stddev")}
    )


def _title_tenure(t) -> DataFrame:
    tenure = analytics.title_tenure(t, AS_OF)
    return tenure.withColumn(
        "avg_years_per_position", F.col("avg_years_per_position").cast("decimal(18,6)")
    )


def _interval_years(t) -> DataFrame:
    years = interval_years("from_date", "to_date", AS_OF)
    return t["dept_emp"].select("emp_no", "rec_id", round_half_up(years).alias("years"))


_BIRTH = ("birth_date", *quality.BIRTH_DATE_RANGE)
_ORDER = ["from_date", "rec_id"]

QUERIES: dict[str, Query] = {
    # sources
    "scan_all_tables": _hr(_row_counts),
    "scan_parquet": _hr(lambda t: t["salaries"]),
    "period_scan": _hr(lambda t: period_rows(t["titles"], *MONTH)),
    # sinks
    "sink_parquet_roundtrip": _saved_tables,
    "sink_parquet_report": _saved_report,
    "sink_csv_roundtrip": _csv_log,
    "sink_run_csv": _csv_run,
    "sink_period_csv": _csv_month,
    "sample_rows": _hr(lambda t: sample_rows(t["employees"], ["emp_no"])),
    # cleaning
    "clean_employees": _faulty(lambda t: cleaning.clean_employees(t["employees"])),
    "clean_departments": _faulty(lambda t: cleaning.clean_departments(t["departments"])),
    "clean_dept_emp": _faulty(lambda t: cleaning.clean_stays(t["dept_emp"], AS_OF)),
    "clean_dept_emp_all_stays": _faulty(
        lambda t: cleaning.clean_stays(t["dept_emp"], AS_OF, ["emp_no", "dept_no", "from_date"])
    ),
    "clean_dept_manager": _faulty(lambda t: cleaning.clean_stays(t["dept_manager"], AS_OF)),
    "clean_salaries": _faulty(lambda t: cleaning.clean_salaries(t["salaries"], AS_OF)),
    "clean_titles": _faulty(lambda t: cleaning.clean_titles(t["titles"], AS_OF)),
    "clean_all_tables": _cleaned(_row_counts),
    "clean_salaries_where_changed": _recleaned("salaries"),
    "close_open_intervals": _hr(lambda t: cleaning.close_open_intervals(t["titles"], AS_OF)),
    "dedupe_by_key": _hr(lambda t: op.dedupe_by_key(t["dept_emp"], ["emp_no", "dept_no"])),
    # data quality
    "dq_null_report": _faulty(_null_reports),
    "dq_domain_check": _faulty(lambda t: quality.check_domain(t["employees"])),
    "dq_range_check": _faulty(
        lambda t: quality.check_range(
            t["salaries"], "salaries", "salary", *cleaning.SALARY_RANGE
        )
    ),
    "dq_range_profile": _faulty(_profile),
    "dq_date_range_check": _faulty(
        lambda t: quality.check_date_range(t["employees"], "employees", *_BIRTH)
    ),
    "dq_date_range_sample": _faulty(
        lambda t: quality.sample_out_of_date_range(
            t["employees"].select("emp_no", "birth_date"), *_BIRTH, order=["emp_no"]
        )
    ),
    "dq_interval_check": _faulty(_interval_checks),
    "dq_interval_sample": _faulty(
        lambda t: quality.sample_reversed_intervals(t["dept_emp"], order=["rec_id"])
    ),
    "dq_suite": _faulty(quality.check_all_tables),
    "dq_suite_while_saving": _watched_checks,
    # state, cost, tenure
    "dept_rotation": _hr(analytics.department_turnover),
    "gender_disparity": _hr(analytics.gender_disparity),
    "manager_retention_rank": _hr(lambda t: analytics.manager_retention_rank(t, AS_OF)),
    "most_senior": _hr(lambda t: analytics.most_senior(t, AS_OF)),
    "salary_trend": _hr(analytics.salary_trend),
    "salary_trend_left": _hr(lambda t: analytics.salary_trend(t, closed="left")),
    "salary_trend_faulty": _faulty(analytics.salary_trend),
    "title_tenure": _hr(_title_tenure),
    "annual_cost": _hr(lambda t: analytics.annual_cost(t, AS_OF)),
    "annual_cost_cleaned": _cleaned(lambda t: analytics.annual_cost(t, AS_OF)),
    "employee_report": _hr(lambda t: analytics.employee_report(t, AS_OF)),
    "employee_report_cleaned": _cleaned(lambda t: analytics.employee_report(t, AS_OF)),
    "annual_cost_bucketed": _bucketed(lambda t: analytics.annual_cost(t, AS_OF)),
    "employee_report_bucketed": _bucketed(lambda t: analytics.employee_report(t, AS_OF)),
    "dept_changers": _cleaned(analytics.department_changers),
    "dept_moves": _hr(analytics.department_moves),
    # changes
    "change_log_dept": _hr(lambda t: change_reports.department_changes(t, *PERIOD)),
    "change_log_salary": _hr(lambda t: change_reports.salary_changes(t, *PERIOD)),
    "change_log_manager": _hr(lambda t: change_reports.manager_changes(t, *PERIOD)),
    "change_log_title": _hr(lambda t: change_reports.title_changes(t, *PERIOD)),
    "change_log": _hr(lambda t: change_reports.change_log(t, *PERIOD)),
    "change_log_summary": _summary,
    "latest_change_report": _hr(lambda t: change_reports.latest_change_report(t, *PERIOD)),
    "lag_change_report": _cleaned(lambda t: change_reports.value_change_report(t, *PERIOD)),
    "monthly_change_report_period": _hr(
        lambda t: change_reports.value_change_report(t, *MONTH, look_back="period")
    ),
    "monthly_change_report": _hr(
        lambda t: change_reports.value_change_report(t, *jobs.month_before(RUN_DATE))
    ),
    "monthly_change_report_from_state": _month_from_state,
    "previous_month_range": _hr(_month_before_hire),
    # generic operators
    "latest_per_key": _hr(lambda t: op.latest_per_key(t["salaries"], ["emp_no"], _ORDER, n=2)),
    "active_at": _hr(lambda t: op.active_at(t["dept_emp"], MID_DAY)),
    "interval_join": _hr(_title_at_pay("both")),
    "interval_join_left": _hr(_title_at_pay("left")),
    "interval_join_distinct": _hr(_distinct_titles_at_pay),
    "detect_changes": _hr(
        lambda t: op.detect_changes(t["titles"], ["emp_no"], "title", _ORDER)
    ),
    "first_last_in_period": _hr(
        lambda t: op.first_last_in_period(t["salaries"], ["emp_no"], "salary", _ORDER, *PERIOD)
    ),
    "share_within_group": _hr(_shares),
    "pivot_values": _hr(_pivot),
    "interval_years": _hr(_interval_years),
    "max_date_rows": _hr(lambda t: op.max_date_rows(t["titles"], ["emp_no"])),
}
