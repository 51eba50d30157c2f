"""The zone in buckets of employee numbers, and the zone cleaned where its sources changed."""

import pytest
from pyspark.sql import functions as F

from registry.queries import AS_OF
from tenureframe.operators import latest_per_key
from tenureframe.plans import analytics, cleaning, jobs
from tenureframe.plans.recleaning import BUCKET, CleanedZone, bucket_digests
from tenureframe.session import scratch_path
from tenureframe.sources import TABLES, read_parquet_tables
from tenureframe.sources.buckets import read_buckets, write_buckets
from tenureframe.sources.orders_binding import faulty_hr_tables

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def raw(spark):
    return faulty_hr_tables(spark, SF_DIR)


@pytest.fixture(scope="module")
def cleaned(raw):
    return {name: rows(df) for name, df in cleaning.clean_all_tables(raw, AS_OF).items()}


@pytest.fixture(scope="module")
def zone(spark, raw):
    path = scratch_path(spark, "zone")
    jobs.run_etl(spark, raw, path, AS_OF, buckets=6)
    return path


def test_buckets_hold_the_same_rows(spark, zone, cleaned):
    tables = read_parquet_tables(spark, zone, record_id=True)
    assert {name: rows(df) for name, df in tables.items()} == cleaned
    files = spark.read.schema(tables["salaries"].schema).parquet(
        tables["salaries"].inputFiles()[0].rsplit("/", 1)[0]
    )
    pairs = files.select("emp_no", F.input_file_name().alias("file")).distinct()
    assert pairs.count() == files.select("emp_no").distinct().count()


def test_no_row_of_a_history_is_shuffled(spark, zone):
    tables = read_parquet_tables(spark, zone, record_id=True)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Departments are small enough to be sent to the tasks, histories are not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2kb")
    try:
        plan = analytics.employee_report(tables, AS_OF)._jdf.queryExecution().executedPlan().toString()
        by_date = latest_per_key(tables["salaries"], ["emp_no"], ["from_date"])
        latest = by_date._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
    assert "Exchange" not in latest


def test_reports_of_both_arrangements_are_equal(spark, raw, zone, cleaned):
    other = scratch_path(spark, "by-date")
    jobs.run_etl(spark, raw, other, AS_OF)
    for report in (analytics.employee_report, analytics.annual_cost, analytics.title_tenure):
        found = [rows(report(read_parquet_tables(spark, p, record_id=True), AS_OF)) for p in (zone, other)]
        assert found[0] == found[1]


def test_buckets_of_an_empty_table_and_of_missing_keys(spark):
    for given in ([], [(None, "a"), (1, None), (1, None)]):
        df = spark.createDataFrame(given, "emp_no long, `a b` string")
        path = scratch_path(spark, "odd rows's")
        write_buckets(df, path, 3)
        assert rows(read_buckets(spark, path, df.schema, 3)) == rows(df)


def test_one_changed_row_is_one_bucket(spark, raw, cleaned):
    zone = CleanedZone(spark, scratch_path(spark, "changed"), buckets=8)
    first = zone.update(raw)
    assert len(first["salaries"]) == 8
    assert {name: rows(df) for name, df in zone.read(AS_OF).items()} == cleaned
    # The same sources in another order: nothing is published.
    mixed = {name: df.repartition(3) for name, df in raw.items()}
    assert not any(zone.update(mixed).values()) and zone.versions.numbers() == [1]

    rec_id = raw["salaries"].agg(F.max("rec_id")).first()[0]
    higher = F.when(F.col("rec_id") == rec_id, F.col("salary") + 1).otherwise(F.col("salary"))
    now = raw | {"salaries": raw["salaries"].withColumn("salary", higher.cast("decimal(10,2)"))}
    done = zone.update(now)
    assert {name: len(found) for name, found in done.items() if found} == {"salaries": 1}
    full = cleaning.clean_all_tables(now, AS_OF)
    assert {name: rows(df) for name, df in zone.read(AS_OF).items()} == {
        name: rows(df) for name, df in full.items()
    }
    # Only that bucket was written.
    folder = zone.versions.folder()
    written = spark.read.parquet(f"{folder}/salaries")
    assert [r[0] for r in written.select(BUCKET).distinct().collect()] == done["salaries"]


def test_few_changed_employees_are_few_buckets(spark, raw):
    zone = CleanedZone(spark, scratch_path(spark, "few"), buckets=40)
    zone.update(raw)
    chosen = F.col("emp_no") % 100 == 1
    now = raw | {"titles": raw["titles"].withColumn("title", F.when(chosen, F.lit("new")).otherwise(F.col("title")))}
    employees = now["titles"].filter(chosen).select("emp_no").distinct().count()
    done = zone.update(now)
    assert 0 < len(done["titles"]) <= employees and not done["salaries"]
    assert rows(zone.read(AS_OF)["titles"]) == rows(cleaning.clean_titles(now["titles"], AS_OF))


def test_gone_rows_removed_versions_and_many_folders(spark, raw):
    zone = CleanedZone(spark, scratch_path(spark, "gone"), buckets=4, most_folders=2)
    zone.update(raw)
    present = raw
    for step in range(1, 4):
        present = present | {
            name: df.filter(F.col("emp_no") % 150 != step) if "emp_no" in df.columns else df
            for name, df in present.items()
        }
        zone.update(present)
        uses = zone.versions.read()["uses"]
        assert len(uses) < 2
        zone.versions.remove_old(keep=1)
        found = zone.read(AS_OF)
        assert rows(found["salaries"]) == rows(cleaning.clean_salaries(present["salaries"], AS_OF))
        assert found["departments"].count() == raw["departments"].count()
    empty = {name: df.limit(0) for name, df in raw.items()}
    zone.update(empty)
    assert all(df.count() == 0 for df in zone.read(AS_OF).values())


def test_digests_tell_rows_apart(spark):
    def digest(*given):
        df = spark.createDataFrame(list(given), "emp_no long, a string, b string")
        return bucket_digests(df, "salaries", 4)

    assert digest((1, "x", None)) != digest((1, None, "x"))
    assert digest((1, "x", None)) != digest((1, "x", None), (1, "x", None))
    assert digest((1, "x", "y"), (1, "z", None)) == digest((1, "z", None), (1, "x", "y"))
    assert digest((None, None, None)) and not digest()


def test_other_rules_clean_everything(spark, raw):
    path = scratch_path(spark, "rules")
    CleanedZone(spark, path, buckets=2).update(raw)
    assert all(CleanedZone(spark, path, buckets=2, rules="2").update(raw).values())
    assert set(CleanedZone(spark, path, buckets=2).read()) == set(TABLES)
