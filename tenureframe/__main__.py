"""Command line for spark-submit: ``python -m tenureframe <job> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import os

from tenureframe.plans import analytics, jobs, quality
from tenureframe.session import remove_scratch, spark_session
from tenureframe.sinks import sample_rows, write_parquet_report
from tenureframe.sources import JdbcConnection, read_jdbc_tables, read_parquet_tables


# Reports over cleaned tables that are written as Parquet: a plan of (tables, as_of).
REPORTS = {
    "employee-report": (analytics.employee_report, "latest state of every employee"),
    "annual-cost": (analytics.annual_cost, "pay by department"),
    "department-changers": (lambda t, _: analytics.department_changers(t), "several stays"),
    "department-moves": (lambda t, _: analytics.department_moves(t), "a row per stay"),
    "turnover": (lambda t, _: analytics.department_turnover(t), "who left, by department"),
    "gender-disparity": (lambda t, _: analytics.gender_disparity(t), "gap of shares"),
    "manager-retention": (analytics.manager_retention_rank, "mean years, by manager"),
    "most-senior": (analytics.most_senior, "longest serving employees"),
    "salary-trend": (lambda t, _: analytics.salary_trend(t), "mean pay by year"),
    "title-tenure": (analytics.title_tenure, "titles and years per title"),
    "quality": (lambda t, _: quality.check_all_tables(t), "violations by rule"),
}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tenureframe")
    job = parser.add_subparsers(dest="job", required=True)

    etl = job.add_parser("etl", help="read raw tables, clean, save, check")
    source = etl.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw", help="folder of raw Parquet tables")
    source.add_argument("--jdbc-url", help="user and password come from DB_USER, DB_PASSWORD")
    etl.add_argument("--jdbc-driver", default="com.mysql.cj.jdbc.Driver")
    etl.add_argument("--partitions", type=int, default=16, help="parallel reads per table")
    etl.add_argument("--out", required=True)
    etl.add_argument("--as-of", type=dt.date.fromisoformat)

    for name, (_, help_text) in REPORTS.items():
        report = job.add_parser(name, help=help_text)
        report.add_argument("--clean", required=True, help="folder written by etl")
        report.add_argument("--out", required=True)
        report.add_argument("--as-of", type=dt.date.fromisoformat)

    for name in ("change-log", "latest-changes", "value-changes"):
        report = job.add_parser(name)
        report.add_argument("--clean", required=True)
        report.add_argument("--out", required=True)
        report.add_argument("--start", type=dt.date.fromisoformat, required=True)
        report.add_argument("--end", type=dt.date.fromisoformat, required=True)

    monthly = job.add_parser("monthly-changes")
    monthly.add_argument("--clean", required=True)
    monthly.add_argument("--out", required=True)
    monthly.add_argument("--run-date", type=dt.date.fromisoformat, required=True)
    monthly.add_argument("--look-back", choices=("full", "period"), default="full")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = spark_session(f"tenureframe {args.job}")
    if args.job == "etl":
        if args.raw:
            raw = read_parquet_tables(spark, args.raw)
        else:
            connection = JdbcConnection(
                args.jdbc_url,
                args.jdbc_driver,
                os.environ.get("DB_USER", ""),
                os.environ.get("DB_PASSWORD", ""),
            )
            raw = read_jdbc_tables(spark, connection, partitions=args.partitions)
        saved, checks = jobs.run_etl(spark, raw, args.out, args.as_of)
        checks.show(1000, truncate=False)
        for title, df in quality.offenders(saved).items():
            print(title)
            df.show(truncate=False)
        for df in saved.values():
            sample_rows(df, df.columns).show(truncate=False)
    else:
        tables = read_parquet_tables(spark, args.clean)
        now = dt.datetime.now()
        if args.job in REPORTS:
            plan, _ = REPORTS[args.job]
            write_parquet_report(plan(tables, args.as_of), args.out)
        elif args.job == "change-log":
            jobs.run_change_log(spark, args.clean, args.start, args.end, args.out).show()
        elif args.job == "latest-changes":
            jobs.run_latest_changes(tables, args.start, args.end, args.out, now)
        elif args.job == "value-changes":
            jobs.run_value_changes(tables, args.start, args.end, args.out, now)
        else:
            jobs.run_monthly_changes(tables, args.run_date, args.out, args.look_back)
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
