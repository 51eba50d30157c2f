"""Plan shapes, independence from partitioning, sources, sinks and jobs."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry.queries import AS_OF, MONTH, PERIOD
from tenureframe import operators as op
from tenureframe.plans import analytics, change_reports, cleaning, jobs
from tenureframe.session import scratch_path
from tenureframe.sinks import period_path, run_stamped_path, save_tables, write_csv_report
from tenureframe.sources import (
    TABLES,
    JdbcConnection,
    JdbcSplit,
    jdbc_split,
    period_rows,
    read_jdbc_tables,
    read_parquet_tables,
    table_schema,
)
from tenureframe.sources.orders_binding import faulty_hr_tables, hr_tables

SF_DIR = "/root/testdata/sf0.001"
D = dt.date


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df, final=False):
    execution = df._jdf.queryExecution()
    if final:
        df.collect()
    return execution.executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return hr_tables(spark, SF_DIR)


REPORTS = {
    "department_turnover": analytics.department_turnover,
    "gender_disparity": analytics.gender_disparity,
    "manager_retention_rank": lambda t: analytics.manager_retention_rank(t, AS_OF),
    "salary_trend": analytics.salary_trend,
    "annual_cost": lambda t: analytics.annual_cost(t, AS_OF),
    "employee_report": lambda t: analytics.employee_report(t, AS_OF),
    "department_changers": analytics.department_changers,
    "change_log": lambda t: change_reports.change_log(t, *PERIOD),
    "value_change_report": lambda t: change_reports.value_change_report(t, *PERIOD),
    "clean_dept_emp": lambda t: cleaning.clean_stays(t["dept_emp"], AS_OF),
}


@pytest.mark.parametrize("name", REPORTS)
def test_row_order_and_partitioning_do_not_matter(tables, name):
    shuffled = {
        table: df.repartition(5).sortWithinPartitions(F.xxhash64(*df.columns, F.lit(7)))
        for table, df in tables.items()
    }
    assert rows(REPORTS[name](shuffled)) == rows(REPORTS[name](tables))


def test_group_limit_before_the_shuffle(tables):
    plan = plan_of(op.latest_per_key(tables["titles"], ["emp_no"], ["from_date", "rec_id"]))
    assert plan.count("WindowGroupLimit") == 2
    plan = plan_of(op.max_date_rows(tables["titles"], ["emp_no"]))
    assert plan.count("WindowGroupLimit") == 2


def test_top_k_and_semi_join(tables):
    plan = plan_of(analytics.most_senior(tables, AS_OF))
    assert "TakeOrderedAndProject" in plan and "LeftSemi" in plan


def test_period_reaches_the_scan(tables):
    scan = plan_of(period_rows(tables["titles"], *MONTH))
    assert "GreaterThanOrEqual(from_date,1997-02-01)" in scan
    lag = plan_of(
        op.detect_changes(
            tables["titles"], ["emp_no"], "title", ["from_date", "rec_id"], *MONTH
        )
    )
    assert "LessThan(from_date,1997-02-01)" in lag
    assert "LessThanOrEqual(from_date,1997-0" in lag


def test_departments_meet_rows_of_the_period_only(tables):
    """Names are joined above the windows, so no history is dealt by department."""
    plan = plan_of(change_reports.value_change_report(tables, *MONTH)).splitlines()
    first_window = next(i for i, line in enumerate(plan) if "Window [" in line)
    scans = [i for i, line in enumerate(plan) if "dept_no" in line and "dept_name" in line]
    assert scans
    for at in scans:
        above = [line for line in plan[:at] if "Join" in line]
        assert above and not any("Window [" in line for line in plan[:first_window])


def test_histories_are_stored_by_date(spark, tables, tmp_path):
    """A month lies in few of the files of a saved history."""
    # Small partitions would be merged into one file.
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        save_tables({"titles": tables["titles"].repartition(8)}, str(tmp_path))
    finally:
        spark.conf.unset(merging)
    ranges = []
    for file in (tmp_path / "titles").glob("part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("from_date")
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert len(ranges) > 1
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(lo <= MONTH[1] and hi >= MONTH[0] for lo, hi in ranges) < len(ranges)


def test_scans_read_only_what_reports_need(tables):
    plan = plan_of(analytics.department_turnover(tables))
    assert "ReadSchema: struct<emp_no:bigint,dept_no:string,to_date:date>" in plan


def test_adaptive_execution_splits_a_hot_employee(spark, tables):
    """Name look-ups are plain joins; Spark splits their hot partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        piled = tables | {
            "titles": tables["titles"]
            .repartition(8)
            .withColumn("emp_no", F.when(F.col("rec_id") % 3 > 0, 1).otherwise(F.col("emp_no")))
        }
        report = change_reports.title_changes(piled, D(1900, 1, 1), D(2100, 1, 1))
        assert report.count() == 1500
        assert "skewed" in plan_of(report, final=True)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class RecordingReader:
    """Stands in for a session: keeps the options instead of opening a database."""

    def __init__(self):
        self.reads = []

    read = property(lambda self: self)

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.reads.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return (D(1985, 1, 1), D(2002, 8, 1)) if "from_date" in self.reads[-1]["dbtable"] else (1, 9)


CONNECTION = JdbcConnection("jdbc:example:hr", "example.Driver", "reader", "secret")


def test_jdbc_options():
    session = RecordingReader()
    read = read_jdbc_tables(session, CONNECTION, partitions=1)
    assert tuple(read) == TABLES
    assert [o["dbtable"] for o in session.reads] == list(TABLES)
    assert session.reads[0]["user"] == "reader" and session.reads[0]["url"] == "jdbc:example:hr"
    assert "partitionColumn" not in session.reads[0]
    assert "secret" not in repr(CONNECTION)


def test_jdbc_split_spreads_histories_by_date():
    session = RecordingReader()
    assert jdbc_split(session, CONNECTION, "salaries", 8) == JdbcSplit(
        "from_date", D(1985, 1, 1), D(2002, 8, 1), 8
    )
    assert jdbc_split(session, CONNECTION, "departments", 8) is None
    read_jdbc_tables(session, CONNECTION, ["employees"], partitions=4)
    assert session.reads[-1] | {
        "partitionColumn": "emp_no",
        "lowerBound": "1",
        "upperBound": "9",
        "numPartitions": "4",
    } == session.reads[-1]


def test_declared_schemas():
    assert table_schema("salaries").simpleString() == (
        "struct<emp_no:bigint,salary:decimal(10,2),from_date:date,to_date:date>"
    )
    assert table_schema("titles", record_id=True).names[-1] == "rec_id"
    assert "rec_id" not in table_schema("employees", record_id=True).names


def test_paths():
    assert period_path("s3a://b/x/", D(2024, 2, 1), D(2024, 2, 29)) == (
        "s3a://b/x/reports/employee_changes_2024-02-01_to_2024-02-29"
    )
    assert run_stamped_path("out", dt.datetime(2025, 4, 1, 3, 30, 5)) == (
        "out/reports/employee_changes_20250401_033005"
    )


def test_etl_then_reports(spark):
    raw = faulty_hr_tables(spark, SF_DIR)
    path = scratch_path(spark, "etl")
    saved, checks = jobs.run_etl(spark, raw, path, AS_OF)
    assert set(saved) == set(TABLES)
    bad = {(r.table_name, r.rule, r.column_name) for r in checks.filter("violations > 0").collect()}
    assert bad == {
        ("employees", "domain", "gender"),
        ("employees", "date_range", "birth_date"),
    }
    clean = read_parquet_tables(spark, path)
    assert clean["salaries"].schema.names == ["emp_no", "salary", "from_date", "to_date"]
    assert analytics.employee_report(clean, AS_OF).count() == 150

    log_path = scratch_path(spark, "log")
    summary = jobs.run_change_log(spark, path, *PERIOD, log_path)
    assert sum(r["count"] for r in summary.collect()) == change_reports.change_log(
        clean, *PERIOD
    ).count()
    head = spark.read.text(log_path).first()[0]
    assert head == "emp_no,employee_name,dept_name,change_date,change_type,old_value,new_value"


def test_a_month_can_be_run_again(spark, tables):
    base = scratch_path(spark, "monthly")
    february = jobs.run_monthly_changes(tables, D(1997, 3, 15), base)
    march = jobs.run_monthly_changes(tables, D(1997, 4, 1), base)
    again = jobs.run_monthly_changes(tables, D(1997, 3, 31), base)
    assert february == again != march
    schema = change_reports.value_change_report(tables, *MONTH).schema
    written = jobs.read_report(spark, again, schema)
    assert rows(written) == rows(change_reports.value_change_report(tables, *MONTH))
    assert jobs.read_report(spark, march, schema).count() > 0


def test_csv_keeps_commas_quotes_and_missing_values(spark):
    df = spark.createDataFrame(
        [("a,b", 'say "x"', None, D(2000, 1, 2))], "a string, b string, c string, d date"
    )
    path = scratch_path(spark, "csv")
    write_csv_report(df, path)
    assert rows(jobs.read_report(spark, path, df.schema)) == rows(df)


def test_csv_keeps_text(spark, tmp_path):
    texts = [" a ", "", None, "line\nbreak", "cr\r\nlf", 'quo"te', "back\\slash", "a,b", '"', "\\", "é"]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    write_csv_report(df.repartition(3), str(tmp_path / "csv"))
    back = jobs.read_report(spark, str(tmp_path / "csv"), df.schema)
    assert {r["n"]: r["text"] for r in back.collect()} == dict(enumerate(texts))


def test_summary_counts_the_log_not_the_file(spark, tmp_path):
    """A line break in a title does not change the counts."""
    tables = hr_tables(spark, SF_DIR)
    clean = cleaning.clean_all_tables(faulty_hr_tables(spark, SF_DIR), AS_OF)
    clean["titles"] = tables["titles"].withColumn("title", F.lit("two\nlines")).drop("rec_id")
    save_tables(clean, str(tmp_path / "clean"))
    summary = jobs.run_change_log(spark, str(tmp_path / "clean"), *PERIOD, str(tmp_path / "log"))
    saved = read_parquet_tables(spark, str(tmp_path / "clean"))
    log = change_reports.change_log(saved, *PERIOD)
    assert rows(summary) == rows(change_reports.change_summary(log))
    assert jobs.read_report(spark, str(tmp_path / "log"), log.schema).count() == log.count()


def test_declared_report_schemas(tables):
    for report, schema in (
        (change_reports.latest_change_report, change_reports.LATEST_SCHEMA),
        (change_reports.value_change_report, change_reports.VALUE_SCHEMA),
    ):
        found = ", ".join(f"{n} {t}" for n, t in report(tables, *MONTH).dtypes)
        assert found == schema


def test_scratch_path_is_shared_and_new(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)
