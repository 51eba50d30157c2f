"""Batch jobs: a run depends on its dates and paths only, and can be repeated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tenureframe.functions.dates import DateLike
from tenureframe.plans.change_reports import (
    change_log,
    change_summary,
    latest_change_report,
    value_change_report,
)
from tenureframe.plans.cleaning import clean_all_tables
from tenureframe.plans.month_state import MonthStates, roll_forward
from tenureframe.plans.quality import checks_of, watch_rules
from tenureframe.session import scratch_path
from tenureframe.sinks import (
    period_path,
    publish_csv_report,
    publish_tables,
    report_folder,
    run_stamped_path,
    write_csv_report,
)
from tenureframe.sinks.files import CSV_READ
from tenureframe.sources import read_parquet_tables
from tenureframe.sources.buckets import BUCKET_KEY, read_buckets

Tables = Mapping[str, DataFrame]


def run_etl(
    spark: SparkSession,
    raw: Tables,
    path: str,
    as_of: DateLike | None = None,
    file_format: str = "parquet",
    buckets: int | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean the tables and publish them as one version; return the tables of that version
    and their check results.

    The checks are counted as the rows are written: the sources are read once, and what was
    written is not read for them. With ``buckets``, the zone is arranged by employee.
    """
    cleaned = clean_all_tables(raw, as_of)
    manifest = publish_tables(cleaned, path, file_format, watch_rules, buckets)
    folder = f"{path.rstrip('/')}/{manifest['folder']}"

    def read(name: str, df: DataFrame) -> DataFrame:
        if buckets and BUCKET_KEY in df.columns:
            return read_buckets(spark, f"{folder}/{name}", df.schema, buckets, file_format)
        return spark.read.format(file_format).schema(df.schema).load(f"{folder}/{name}")

    saved = {name: read(name, df) for name, df in cleaned.items()}
    return saved, checks_of(spark, manifest)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """A report as it was written: the last published version, if there are versions."""
    return spark.read.schema(schema).options(**CSV_READ).csv(report_folder(spark, path))


def run_change_log(
    spark: SparkSession, clean_path: str, start: DateLike, end: DateLike, path: str
) -> DataFrame:
    """Write the change log as CSV. The log is computed once, into the scratch folder;
    file and summary both come from there."""
    log = change_log(read_parquet_tables(spark, clean_path), start, end)
    stage = scratch_path(spark, "change-log")
    log.write.parquet(stage)
    staged = spark.read.schema(log.schema).parquet(stage)
    write_csv_report(staged.orderBy("change_date", "emp_no"), path)
    return change_summary(staged)


def run_latest_changes(
    tables: Tables, start: DateLike, end: DateLike, base: str, run_time: dt.datetime
) -> str:
    """Write the latest change per employee and kind to a folder of this run."""
    path = run_stamped_path(base, run_time)
    write_csv_report(latest_change_report(tables, start, end), path)
    return path


def run_value_changes(
    tables: Tables, start: DateLike, end: DateLike, base: str, run_time: dt.datetime
) -> str:
    """Write previous and new values of a period to a folder of this run."""
    path = run_stamped_path(base, run_time)
    write_csv_report(value_change_report(tables, start, end), path)
    return path


def month_before(run_date: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the month before, for folder names and filters."""
    last = run_date.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def run_monthly_changes(
    tables: Tables, run_date: dt.date, base: str, look_back: str = "full"
) -> str:
    """Publish last month's changes; a second run replaces that month only, and its readers
    have the former version until the new one is whole."""
    start, end = month_before(run_date)
    path = period_path(base, start, end)
    publish_csv_report(value_change_report(tables, start, end, look_back), path)
    return path


def run_month_from_state(
    spark: SparkSession, tables: Tables, run_date: dt.date, base: str
) -> str:
    """As ``run_monthly_changes``, from the state at the end of the month before and the
    month's own rows; then the state at the month's end is published for the next run."""
    start, end = month_before(run_date)
    states = MonthStates(spark, base)
    state = states.before(tables, start)
    path = period_path(base, start, end)
    publish_csv_report(value_change_report(tables, start, end, before=state), path)
    states.publish(roll_forward(state, tables, start, end), end)
    return path
