"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of threads.
Every query is written to the ``noop`` sink, so that all of its columns are
computed and nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.queries import PERIOD, QUERIES, _cleaned_tables  # noqa: E402
from tenureframe import operators as op  # noqa: E402
from tenureframe.plans import analytics, change_reports  # noqa: E402
from tenureframe.session import scratch_path  # noqa: E402
from tenureframe.sources.orders_binding import _history, hr_tables, tables_path  # noqa: E402
from tenureframe.sources.schemas import HISTORY_TABLES, table_schema  # noqa: E402

HEADLINE = (
    "scan_parquet",
    "period_scan",
    "clean_employees",
    "clean_dept_emp",
    "clean_salaries",
    "clean_titles",
    "dq_suite",
    "dept_rotation",
    "gender_disparity",
    "manager_retention_rank",
    "most_senior",
    "salary_trend",
    "title_tenure",
    "annual_cost",
    "employee_report",
    "dept_changers",
    "change_log",
    "latest_change_report",
    "lag_change_report",
    "monthly_change_report",
    "interval_join",
    "detect_changes",
    "latest_per_key",
    "max_date_rows",
)
ROUNDS = 2


def hot_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables as they are when one customer has placed a third of all orders."""
    one = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = scratch_path(spark, "hot-history")
    _history(orders.withColumn("o_custkey", one.cast("bigint"))).write.parquet(path)
    return hr_tables(spark, sf_dir) | {
        name: spark.read.schema(table_schema(name, record_id=True)).parquet(path)
        for name in HISTORY_TABLES
    }


def _distinct_titles(t) -> DataFrame:
    pay = t["salaries"].select("emp_no", F.col("from_date").alias("pay_date"))
    held = t["titles"].select("emp_no", "title", "from_date", "to_date")
    return op.join_distinct(pay, held, "emp_no", "pay_date")


HOT = {
    "hot_detect_changes": lambda t: op.detect_changes(
        t["titles"], ["emp_no"], "title", ["from_date", "rec_id"]
    ),
    "hot_value_changes": lambda t: change_reports.value_change_report(t, *PERIOD),
    "hot_salary_trend": analytics.salary_trend,
    "hot_interval_join_distinct": _distinct_titles,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(os.environ.get("BENCH_ONLY", ",".join([*HEADLINE, *HOT])).split(","))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tenureframe bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        begin = time.perf_counter()
        action()
        return time.perf_counter() - begin

    # Start the executors before the clock does.
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {
        "derive_hr_tables": timed(lambda: tables_path(spark, sf_dir)),
        "write_cleaned_tables": timed(lambda: _cleaned_tables(spark, sf_dir)),
    }
    hot = hot_tables(spark, sf_dir)
    runs = {name: lambda name=name: QUERIES[name](spark, sf_dir) for name in HEADLINE}
    runs |= {name: lambda plan=plan: plan(hot) for name, plan in HOT.items()}
    for name, run in runs.items():
        if name in only:

            def write(run=run):
                run().write.format("noop").mode("overwrite").save()

            seconds[name] = min(timed(write) for _ in range(ROUNDS))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
