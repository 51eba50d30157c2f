"""Publication of versions: what readers see before, while and after a run writes."""

import datetime as dt
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from registry.queries import AS_OF
from tenureframe.plans import change_reports, jobs, quality
from tenureframe.session import scratch_path
from tenureframe.sinks import Versions, publish_csv_report, publish_tables, published_folder, report_folder
from tenureframe.sources import TABLES, read_parquet_tables
from tenureframe.sources.orders_binding import faulty_hr_tables, hr_tables

SF_DIR = "/root/testdata/sf0.001"
D = dt.date
FAILED = (PySparkException, Py4JJavaError)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    return hr_tables(spark, SF_DIR)


def test_a_failed_write_leaves_all_tables_of_the_former_version(spark, tables, tmp_path):
    zone = str(tmp_path / "zone")
    publish_tables({n: df.limit(20) for n, df in tables.items()}, zone)
    before = {n: rows(df) for n, df in read_parquet_tables(spark, zone, record_id=True).items()}
    # The fifth of the tables fails in a task, after four have been written.
    broken = dict(tables)
    broken["salaries"] = tables["salaries"].withColumn(
        "salary", F.when(F.col("rec_id") % 500 == 7, F.raise_error(F.lit("no disk left"))).otherwise(F.col("salary"))
    )
    with pytest.raises(FAILED):
        publish_tables(broken, zone)
    versions = list((tmp_path / "zone" / "_versions").iterdir())
    assert len(versions) == 2
    found = read_parquet_tables(spark, zone, record_id=True)
    assert {n: rows(df) for n, df in found.items()} == before
    assert all(len(r) <= 20 for r in before.values()) and set(before) == set(TABLES)
    # The next run succeeds, and all tables change together.
    publish_tables(tables, zone)
    found = read_parquet_tables(spark, zone, record_id=True)
    assert {n: df.count() for n, df in found.items()} == {n: df.count() for n, df in tables.items()}


def test_readers_keep_their_version_until_it_is_removed(spark, tmp_path):
    zone = str(tmp_path)
    for n in (3, 5, 8):
        publish_tables({"employees": spark.range(n)}, zone)
    versions = Versions(spark, zone)
    assert versions.numbers() == [1, 2, 3] and versions.read(9) is None
    old = spark.read.parquet(f"{versions.folder(1)}/employees")
    publish_tables({"employees": spark.range(13)}, zone)
    assert old.count() == 3
    assert versions.remove_old(keep=2) == [1, 2] and versions.numbers() == [3, 4]
    assert not Path(old.inputFiles()[0].removeprefix("file://")).exists()
    assert spark.read.parquet(f"{published_folder(spark, zone)}/employees").count() == 13
    assert versions.remove_old() == []
    with pytest.raises(ValueError):
        versions.remove_old(keep=0)


def test_a_number_is_given_once(spark, tmp_path, monkeypatch):
    versions = Versions(spark, str(tmp_path))
    versions.publish({"a": lambda folder: None})
    monkeypatch.setattr(Versions, "numbers", lambda self: [])
    with pytest.raises(RuntimeError):
        versions.publish({"a": lambda folder: None})
    monkeypatch.undo()
    assert versions.numbers() == [1]
    assert [p.name for p in (tmp_path / "_manifests").glob("[!.]*")] == ["0000000001.json"]


def test_paths_without_versions_are_read_as_they_are(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert published_folder(spark, f"{tmp_path}/plain/") == f"{tmp_path}/plain"
    assert report_folder(spark, str(tmp_path)) == str(tmp_path)
    assert Versions(spark, str(tmp_path / "missing")).read() is None


def test_a_month_that_fails_half_way_keeps_its_report(spark, tables, tmp_path):
    base = str(tmp_path)
    run_date = D(1997, 3, 15)
    path = jobs.run_monthly_changes(tables, run_date, base)
    before = rows(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA))
    broken = tables | {
        "titles": tables["titles"].withColumn(
            "title", F.when(F.col("rec_id") % 5 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("title"))
        )
    }
    with pytest.raises(FAILED):
        jobs.run_monthly_changes(broken, run_date, base)
    assert rows(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA)) == before != []
    assert jobs.run_monthly_changes(tables, run_date, base) == path
    assert rows(jobs.read_report(spark, path, change_reports.VALUE_SCHEMA)) == before
    assert Versions(spark, path).numbers() == [1, 2]


def test_empty_reports_are_published(spark, tmp_path):
    df = spark.createDataFrame([], "a string, n long")
    publish_csv_report(df, str(tmp_path))
    assert jobs.read_report(spark, str(tmp_path), df.schema).count() == 0


def test_checks_come_from_the_write_alone(spark):
    """The same rows as checks of what was written; nothing of it is read for them."""
    raw = faulty_hr_tables(spark, SF_DIR)
    path = scratch_path(spark, "watched")
    saved, checks = jobs.run_etl(spark, raw, path, AS_OF)
    assert "Scan parquet" not in checks._jdf.queryExecution().executedPlan().toString()
    assert rows(checks) == rows(quality.check_all_tables(saved))
    manifest = Versions(spark, path).read()
    assert {n: p["rows"] for n, p in manifest["parts"].items()} == {n: df.count() for n, df in saved.items()}
    uncleaned = publish_tables(raw, scratch_path(spark, "raw"), watch=quality.watch_rules)
    assert rows(quality.checks_of(spark, uncleaned)) == rows(quality.check_all_tables(raw))


def test_checks_of_empty_tables(spark, tables):
    empty = {name: df.filter("false") for name, df in tables.items()}
    manifest = publish_tables(empty, scratch_path(spark, "empty"), watch=quality.watch_rules)
    assert {part["rows"] for part in manifest["parts"].values()} == {0}
    assert {r["violations"] for r in quality.checks_of(spark, manifest).collect()} == {0}
