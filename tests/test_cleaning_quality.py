"""Cleaning rules and checks on hand-made rows."""

import datetime as dt

import pytest

from tenureframe.plans import cleaning, quality

D = dt.date
AS_OF = D(2010, 6, 30)
TEXT_STAYS = "emp_no long, dept_no string, from_date string, to_date string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stays_from_text(spark):
    raw = spark.createDataFrame(
        [
            (1, "d1", "2000-01-01", "2001-01-01"),
            (1, "d1", "2003-01-01", "9999-01-01"),
            (1, "d2", "2001-01-01", "2003-01-01"),
            (2, "d1", "2001-01-01", "2000-12-31"),
            (3, "d1", "2001-01-01", None),
            (4, "d1", "not a date", "2001-01-01"),
            (5, "d1", "2001-01-01", "2001-01-01"),
        ],
        TEXT_STAYS,
    )
    assert rows(cleaning.clean_stays(raw, AS_OF)) == [
        (1, "d1", D(2003, 1, 1), AS_OF),
        (1, "d2", D(2001, 1, 1), D(2003, 1, 1)),
        (5, "d1", D(2001, 1, 1), D(2001, 1, 1)),
    ]
    kept = cleaning.clean_stays(raw, AS_OF, ["emp_no", "dept_no", "from_date"])
    assert kept.filter("emp_no = 1").count() == 3


def test_salaries_from_text(spark):
    raw = spark.createDataFrame(
        [
            (1, "1000", "2000-01-01", "9999-01-01"),
            (2, "999.99", "2000-01-01", "9999-01-01"),
            (3, "1000000", "2000-01-01", "2001-01-01"),
            (4, "1000000.01", "2000-01-01", "2001-01-01"),
            (5, "many", "2000-01-01", "2001-01-01"),
            (6, None, "2000-01-01", "2001-01-01"),
            (7, "1234.565", "2000-01-01", "2001-01-01"),
        ],
        "emp_no long, salary string, from_date string, to_date string",
    )
    cleaned = cleaning.clean_salaries(raw, AS_OF)
    assert cleaned.schema["salary"].dataType.simpleString() == "decimal(10,2)"
    assert {(r.emp_no, str(r.salary), r.to_date) for r in cleaned.collect()} == {
        (1, "1000.00", AS_OF),
        (3, "1000000.00", D(2001, 1, 1)),
        (7, "1234.57", D(2001, 1, 1)),
    }


def test_titles_are_filled_after_dedupe(spark):
    raw = spark.createDataFrame(
        [
            (1, "  senior  ENGINEER ", "2000-01-01", "2001-01-01"),
            (1, "Senior  Engineer", "2000-01-01", "2002-01-01"),
            (2, None, "2000-01-01", "9999-01-01"),
            (2, None, "2000-01-01", "2001-01-01"),
        ],
        "emp_no long, title string, from_date string, to_date string",
    )
    cleaned = cleaning.clean_titles(raw, AS_OF)
    assert rows(cleaned) == [
        (1, "Senior  Engineer", D(2000, 1, 1), D(2002, 1, 1)),
        (2, "TITLE_UNKNOWN", D(2000, 1, 1), AS_OF),
    ]
    again = cleaning.clean_titles(cleaned, AS_OF)
    assert "Title_unknown" in {r.title for r in again.collect()}


def test_employees_and_departments(spark):
    people = spark.createDataFrame(
        [
            (1, "1960-01-01", None, "Fox", "M", "1990-01-01"),
            (2, "1960-01-01", "Ann", None, None, "bad"),
            (3, None, "Bo", "Lee", "X", "1990-01-01"),
            (1, "1960-01-01", None, "Fox", "M", "1990-01-01"),
        ],
        "emp_no long, birth_date string, first_name string, last_name string, "
        "gender string, hire_date string",
    )
    day = D(1960, 1, 1)
    assert rows(cleaning.clean_employees(people)) == [
        (1, day, "UNKNOWN", "Fox", "M", D(1990, 1, 1)),
        (2, day, "Ann", "UNKNOWN", "U", None),
        (3, None, "Bo", "Lee", "U", D(1990, 1, 1)),
    ]
    places = spark.createDataFrame(
        [("d1", "  Sales "), ("d2", None), ("d1", "Sales")], "dept_no string, dept_name string"
    )
    assert rows(cleaning.clean_departments(places)) == [
        ("d1", "Sales"),
        ("d2", "DEPARTMENT_UNKNOWN"),
    ]


def test_cleaning_twice_changes_nothing_more(spark):
    people = spark.createDataFrame(
        [(1, D(1960, 1, 1), None, "Fox", "Q", D(1990, 1, 1))],
        "emp_no long, birth_date date, first_name string, last_name string, gender string, "
        "hire_date date",
    )
    pay = spark.createDataFrame(
        [(1, 5000, D(2000, 1, 1), D(9999, 1, 1))],
        "emp_no long, salary int, from_date date, to_date date",
    )
    places = spark.createDataFrame([("d2", None)], "dept_no string, dept_name string")
    for df, rule in (
        (people, cleaning.clean_employees),
        (pay, lambda d: cleaning.clean_salaries(d, AS_OF)),
        (places, cleaning.clean_departments),
    ):
        once = rule(df)
        assert rows(rule(once)) == rows(once)


def test_nan_counts_as_missing_in_floats(spark):
    df = spark.createDataFrame(
        [(1.0, float("nan"), "a"), (float("nan"), None, None)], "d double, f float, s string"
    )
    report = quality.check_nulls(df, "t")
    assert rows(report) == [("t", "d", 1), ("t", "f", 2), ("t", "s", 1)]


def test_null_is_not_outside(spark):
    df = spark.createDataFrame(
        [("M", 5, D(1899, 1, 1)), ("X", 50, D(2000, 1, 1)), (None, None, None)],
        "gender string, salary int, birth_date date",
    )
    assert rows(quality.check_domain(df)) == [("X", 1)]
    assert rows(quality.check_range(df, "t", "salary", 10, 60)) == [("t", "range", "salary", 1)]
    dates = quality.check_date_range(df, "t", "birth_date", "1900-01-01", "2023-12-31")
    assert dates.first()["violations"] == 1
    sample = quality.sample_out_of_date_range(df, "birth_date", "1900-01-01", "2023-12-31")
    assert [r.birth_date for r in sample.collect()] == [D(1899, 1, 1)]


def test_interval_check(spark):
    df = spark.createDataFrame(
        [(D(2000, 1, 2), D(2000, 1, 1)), (D(2000, 1, 1), None), (None, D(2000, 1, 1))],
        "from_date date, to_date date",
    )
    assert rows(quality.check_intervals(df, "t")) == [("t", "interval", "to_date", 1, False)]
    assert quality.check_intervals(df.filter("to_date is null"), "t").first()["passed"]


def test_profile(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 50)], "salary int")
    found = quality.profile_out_of_range(df, "salary", 10, 60).first().asDict()
    assert found["count"] == 4 and found["mean"] == 2.5
    assert (found["min"], found["q25"], found["q50"], found["q75"], found["max"]) == (1, 1, 2, 3, 4)
    assert found["stddev"] == pytest.approx(1.2909944)


def test_suite_runs_rules_by_table(spark):
    stays = spark.createDataFrame(
        [(1, "d1", D(2000, 1, 1), D(1999, 1, 1))],
        "emp_no long, dept_no string, from_date date, to_date date",
    )
    rules = {r.rule for r in quality.check_table(stays, "dept_emp").collect()}
    assert rules == {"null", "interval"}
    cleaned_gender = spark.createDataFrame([("U", None)], "gender string, birth_date date")
    found = quality.check_table(cleaned_gender, "employees").collect()
    assert {r.rule: r.violations for r in found if r.column_name == "gender"} == {
        "null": 0,
        "domain": 1,
    }


def test_one_scan_per_table(spark):
    stays = spark.createDataFrame([(1, "d1", None, None)], "emp_no long, dept_no string, from_date date, to_date date")
    plan = quality.check_table(stays, "dept_emp")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
