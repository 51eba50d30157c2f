"""Table and report writers.

``publish_tables`` and ``publish_csv_report`` make a new version visible at once; the other
writers replace what the path held before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tenureframe.sources.buckets import BUCKET_KEY, write_buckets
from tenureframe.sources.schemas import RECORD_ID
from tenureframe.versions import Versions, Writer

Watch = Callable[[DataFrame, str], tuple[DataFrame, Callable[[], Mapping]]]

# The CSV form and the object names of the reports.
CSV_OPTIONS = {"header": "true", "sep": ",", "dateFormat": "yyyy-MM-dd"}

# Text comes back as it was: blanks stay, quotes are doubled and nothing else is
# escaped, an empty text is quoted and a missing one is not. On reading, a missing
# value is told from an empty one by a mark that no text should be.
_TEXT_KEPT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_WRITE = CSV_OPTIONS | _TEXT_KEPT | {
    "nullValue": "",
    "emptyValue": '""',
    # A file with line breaks inside values is read by one task.
    "maxRecordsPerFile": "1000000",
}
CSV_READ = CSV_OPTIONS | _TEXT_KEPT | {
    "nullValue": "\u0000",
    "emptyValue": "",
    "multiLine": "true",
}
REPORT_FOLDER = "reports"
REPORT_STEM = "employee_changes"


def by_date(df: DataFrame) -> DataFrame:
    """Histories are sorted by date across files, so a read of a period skips the others;
    the further column keeps a day with very many rows divisible. Other tables stay."""
    if "from_date" not in df.columns:
        return df
    finer = [c for c in (RECORD_ID, "emp_no") if c in df.columns][:1]
    return df.repartitionByRange("from_date", *finer).sortWithinPartitions("from_date", *finer)


def save_tables(
    tables: Mapping[str, DataFrame], path: str, file_format: str = "parquet"
) -> None:
    """One folder per table, replaced in place."""
    for name, df in tables.items():
        by_date(df).write.mode("overwrite").format(file_format).save(f"{path.rstrip('/')}/{name}")


def publish_tables(
    tables: Mapping[str, DataFrame],
    path: str,
    file_format: str = "parquet",
    watch: Watch | None = None,
    buckets: int | None = None,
) -> dict:
    """All tables as one version; returns its manifest, with the rows of every table.

    With ``buckets``, tables with employee numbers are written in so many buckets of them
    instead of by date, for reports that bring an employee's rows together.

    ``watch`` may add metrics to a table as it is written: it takes (table as written,
    name) and returns the table with its metrics and a function that gives their values
    when the table is written, for the manifest.
    """

    def writer(name: str, df: DataFrame) -> Writer:
        def write(folder: str) -> Mapping:
            in_buckets = buckets and BUCKET_KEY in df.columns
            rows, values = df if in_buckets else by_date(df), None
            if watch is not None:
                rows, values = watch(rows, name)
            if in_buckets:
                write_buckets(rows, folder, buckets, file_format)
            else:
                rows.write.format(file_format).save(folder)
            return values() if values else {}

        return write

    spark = next(iter(tables.values())).sparkSession
    writers = {name: writer(name, df) for name, df in tables.items()}
    return Versions(spark, path).publish(writers, **({"buckets": buckets} if buckets else {}))


def write_parquet_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def publish_csv_report(df: DataFrame, path: str) -> None:
    """The report as a new version of the path; the former one stays until it is there."""
    Versions(df.sparkSession, path).publish(
        {REPORT_STEM: lambda folder: df.write.options(**CSV_WRITE).csv(folder)}
    )


def report_folder(spark: SparkSession, path: str) -> str:
    """Where the files of a report lie, published or written in place."""
    folder = Versions(spark, path).folder()
    return f"{folder}/{REPORT_STEM}" if folder else path


def run_stamped_path(base: str, run_time: dt.datetime) -> str:
    """A folder per run."""
    return f"{base.rstrip('/')}/{REPORT_FOLDER}/{REPORT_STEM}_{run_time:%Y%m%d_%H%M%S}"


def period_path(base: str, start: dt.date, end: dt.date) -> str:
    """A folder per period, so that a second run replaces that period only."""
    return f"{base.rstrip('/')}/{REPORT_FOLDER}/{REPORT_STEM}_{start}_to_{end}"


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(*order).limit(n)
