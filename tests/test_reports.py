"""Edge cases of the reports on a small hand-made company."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenureframe.plans import analytics, change_reports, cleaning

D = dt.date
OPEN = D(9999, 1, 1)
AS_OF = D(2001, 1, 1)
STAY = "emp_no long, dept_no string, from_date date, to_date date"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def company(spark, **changes):
    data = {
        "employees": (
            [
                (1, D(1960, 1, 1), "Ada", "One", "F", D(1990, 1, 1)),
                (2, D(1960, 1, 1), "Bob", "Two", "M", D(1991, 1, 1)),
                (3, D(1960, 1, 1), "Cy", None, "M", D(1992, 1, 1)),
                (4, D(1960, 1, 1), "Di", "Four", "F", D(1993, 1, 1)),
            ],
            "emp_no long, birth_date date, first_name string, last_name string, gender string, "
            "hire_date date",
        ),
        "departments": (
            [("d1", "Sales"), ("d2", "Research"), ("d3", "Empty")],
            "dept_no string, dept_name string",
        ),
        "dept_emp": (
            [
                (1, "d1", D(1990, 1, 1), D(1995, 1, 1)),
                (1, "d2", D(1995, 1, 1), D(1996, 6, 1)),
                (1, "d1", D(1996, 6, 1), OPEN),
                (2, "d1", D(1991, 1, 1), D(1996, 1, 1)),
                (2, "d1", D(1996, 1, 1), OPEN),
                (3, "d2", D(1992, 1, 1), D(1996, 12, 31)),
                (4, "d1", D(1993, 1, 1), OPEN),
            ],
            STAY,
        ),
        "dept_manager": (
            [
                (1, "d1", D(1990, 1, 1), D(1991, 1, 1)),
                (1, "d1", D(1996, 1, 1), OPEN),
                (2, "d1", D(1991, 1, 1), D(1996, 1, 1)),
                (3, "d2", D(1996, 12, 31), OPEN),
            ],
            STAY,
        ),
        "salaries": (
            [
                (1, 100, D(1990, 1, 1), D(1995, 1, 1)),
                (1, 200, D(1995, 1, 1), D(1996, 1, 1)),
                (1, 300, D(1996, 1, 1), OPEN),
                (2, 100, D(1996, 1, 1), D(1996, 6, 1)),
                (2, 100, D(1996, 6, 1), OPEN),
                (3, 100, D(1996, 1, 1), D(1996, 12, 31)),
                (3, 150, D(1996, 12, 31), OPEN),
            ],
            "emp_no long, salary int, from_date date, to_date date",
        ),
        "titles": (
            [
                (1, "Staff", D(1990, 1, 1), D(1995, 1, 1)),
                (1, "Senior", D(1995, 1, 1), OPEN),
                (2, "Staff", D(1991, 1, 1), OPEN),
                (3, "Staff", D(1996, 1, 1), OPEN),
            ],
            "emp_no long, title string, from_date date, to_date date",
        ),
    } | changes
    tables = {name: spark.createDataFrame(*given) for name, given in data.items()}
    tables["salaries"] = tables["salaries"].withColumn(
        "salary", F.col("salary").cast("decimal(10,2)")
    )
    return tables


@pytest.fixture(scope="module")
def tables(spark):
    return company(spark)


def test_turnover_leaves_out_departments_without_leavers(spark, tables):
    assert rows(analytics.department_turnover(tables)) == [
        ("d1", "Sales", 2, 3, 66.67),
        ("d2", "Research", 2, 2, 100.0),
    ]
    nobody_left = company(spark, dept_emp=([(1, "d1", D(1990, 1, 1), OPEN)], STAY))
    assert analytics.department_turnover(nobody_left).count() == 0


def test_one_gender_department_has_no_gap_and_ranks_last(spark):
    people = "emp_no long, birth_date date, first_name string, last_name string, gender string, hire_date date"
    given = company(
        spark,
        employees=(
            [(i, None, "a", "b", g, None) for i, g in enumerate("FMMFM")],
            people,
        ),
        dept_emp=(
            [(i, d, D(1990, 1, 1), OPEN) for i, d in enumerate(["d1", "d1", "d1", "d2", "d3"])],
            STAY,
        ),
    )
    found = {r["departamento"]: tuple(r)[1:] for r in analytics.gender_disparity(given).collect()}
    assert found == {
        "Sales": (66.67, 33.33, 33.33, "Masculino", 1),
        "Research": (None, 100.0, None, "Femenino", 2),
        "Empty": (100.0, None, None, "Femenino", 2),
    }


def test_manager_figures_belong_to_the_department(tables):
    found = analytics.manager_retention_rank(tables, AS_OF).collect()
    by_manager = {(r["manager_id"], r["department"]): r for r in found}
    assert len(found) == 3, "two terms in one department are one row"
    first, second = by_manager[1, "Sales"], by_manager[2, "Sales"]
    assert first["avg_retention_years"] == second["avg_retention_years"]
    assert first["retention_rank"] == second["retention_rank"] == 1
    assert by_manager[3, "Research"]["retention_rank"] == 3
    assert [r["retention_rank"] for r in found] == [3, 1, 1]
    assert first["employee_count"] == 3


def test_most_senior_needs_an_open_stay_and_keeps_ties(spark, tables):
    found = analytics.most_senior(tables, AS_OF).collect()
    assert [r["emp_no"] for r in found] == [1, 2], "3 has left, 4 has no title"
    tied = company(
        spark,
        titles=(
            [(1, t, D(1995, 1, 1), OPEN) for t in ("A", "B")],
            "emp_no long, title string, from_date date, to_date date",
        ),
        dept_emp=([(1, d, D(1995, 1, 1), OPEN) for d in ("d1", "d2")], STAY),
    )
    assert analytics.most_senior(tied, AS_OF).count() == 4
    assert analytics.most_senior(tied, AS_OF, n=3).count() == 3


def test_salary_trend_counts_boundary_dates_twice(tables):
    both = {tuple(r)[:3]: tuple(r)[3:] for r in analytics.salary_trend(tables, "both").collect()}
    left = {tuple(r)[:3]: tuple(r)[3:] for r in analytics.salary_trend(tables, "left").collect()}
    assert both["Sales", "Staff", 1995] == (200.0, 1)
    assert ("Sales", "Staff", 1995) not in left
    assert left["Research", "Senior", 1995] == (200.0, 1)


def test_missing_pay_is_staff_but_not_in_the_mean(spark):
    """Pay of 100 and NULL has the mean 100, as avg() gives; NULL alone has none."""
    tables = company(
        spark,
        salaries=(
            [
                (1, 100, D(1996, 7, 1), OPEN),
                (2, None, D(1996, 7, 1), OPEN),
                (4, None, D(1997, 7, 1), OPEN),
            ],
            "emp_no long, salary int, from_date date, to_date date",
        ),
        titles=(
            [(e, "Staff", D(1990, 1, 1), OPEN) for e in (1, 2, 4)],
            "emp_no long, title string, from_date date, to_date date",
        ),
    )
    found = {(r[0], r[2]): (r[3], r[4]) for r in analytics.salary_trend(tables).collect()}
    assert found["Sales", 1996] == (100.0, 2)
    assert found["Sales", 1997] == (None, 1)


def test_most_senior_with_very_many_ties(spark):
    """1,000 titles and 1,000 stays on one day: ten rows, without a million pairs."""
    names = [f"n{i:04d}" for i in range(1000)]
    tied = company(
        spark,
        titles=(
            [(1, n, D(1995, 1, 1), OPEN) for n in names],
            "emp_no long, title string, from_date date, to_date date",
        ),
        departments=([(n, n.upper()) for n in names], "dept_no string, dept_name string"),
        dept_emp=([(1, n, D(1995, 1, 1), OPEN) for n in names], STAY),
    )
    found = analytics.most_senior(tied, AS_OF).collect()
    assert [(r["actual_title"], r["actual_dept"]) for r in found] == [
        ("n0000", f"N{i:04d}") for i in range(10)
    ]
    twice = company(
        spark,
        titles=(
            [(1, "Staff", D(1995, 1, 1), OPEN)] * 2,
            "emp_no long, title string, from_date date, to_date date",
        ),
    )
    assert analytics.most_senior(twice, AS_OF).count() == 2


def test_department_moves_have_a_row_per_stay(tables):
    found = rows(analytics.department_moves(tables).select("emp_no", "dept_no", "total_cambios"))
    assert found == [(1, "d1", 3), (1, "d1", 3), (1, "d2", 3), (2, "d1", 2), (2, "d1", 2)]


def test_employee_without_title_is_kept(tables):
    found = {r["emp_no"]: r for r in analytics.title_tenure(tables, AS_OF).collect()}
    assert found[4]["total_titles"] == 0 and found[4]["avg_years_per_position"] is None
    assert found[1]["total_titles"] == 2


def test_annual_cost_needs_the_cleaning_date(tables):
    raw = {r[0]: str(r[1]) for r in analytics.annual_cost(tables, AS_OF).collect()}
    assert raw == {"Sales": "400.00"}
    cleaned = cleaning.clean_all_tables(
        tables | {"salaries": tables["salaries"].withColumn("salary", F.col("salary") * 100)},
        AS_OF,
    )
    assert analytics.annual_cost(cleaned, AS_OF).count() == 1
    assert analytics.annual_cost(cleaned, AS_OF + dt.timedelta(days=1)).count() == 0


def test_employee_report_keeps_everybody(tables):
    found = {r["emp_no"]: r for r in analytics.employee_report(tables, AS_OF).collect()}
    assert set(found) == {1, 2, 3, 4}
    assert found[1]["current_department"] == "Sales" and found[1]["current_title"] == "Senior"
    assert str(found[1]["current_salary"]) == "300.00"
    assert found[1]["tenure_years"] == 11.01
    assert found[3]["full_name"] is None, "a missing last name leaves no full name"
    assert found[4]["current_title"] is None and found[4]["current_salary"] is None


def test_department_changers_order_their_moves(tables):
    found = {r["emp_no"]: r for r in analytics.department_changers(tables).collect()}
    assert set(found) == {1, 2}
    assert found[1]["departamentos"] == ["d1", "d2", "d1"]
    assert found[1]["fechas_cambio"] == [D(1990, 1, 1), D(1995, 1, 1), D(1996, 6, 1)]
    assert set(r["emp_no"] for r in analytics.department_changers(tables, 3).collect()) == {1}
    cleaned = tables | {"dept_emp": cleaning.clean_stays(tables["dept_emp"], AS_OF)}
    assert [r["departamentos"] for r in analytics.department_changers(cleaned).collect()] == [
        ["d2", "d1"]
    ], "one stay per department is left after cleaning"


YEAR = (D(1996, 1, 1), D(1996, 12, 31))


def test_department_changes_look_before_the_period(tables):
    assert rows(change_reports.department_changes(tables, *YEAR)) == [
        ("1", "Ada One", "Sales", D(1996, 6, 1), "department_change", "Research", "Sales"),
    ]
    everything = change_reports.department_changes(tables, D(1900, 1, 1), D(2000, 1, 1))
    assert everything.count() == 2, "leave and return"


def test_salary_changes_need_two_values_in_the_period(tables):
    assert rows(change_reports.salary_changes(tables, *YEAR)) == [
        ("3", "Cy", "N/A", D(1996, 1, 1), "salary_change", "100.00", "150.00"),
    ]


def test_both_period_edges_count(tables):
    assert rows(change_reports.manager_changes(tables, *YEAR)) == [
        ("N/A", "Ada One", "Sales", D(1996, 1, 1), "manager_change", "N/A", "N/A"),
        ("N/A", "Cy", "Research", D(1996, 12, 31), "manager_change", "N/A", "N/A"),
    ]
    assert change_reports.title_changes(tables, *YEAR).count() == 1


def test_change_log_is_the_sum_of_its_kinds(tables):
    log = change_reports.change_log(tables, *YEAR)
    parts = [
        change_reports.department_changes(tables, *YEAR),
        change_reports.salary_changes(tables, *YEAR),
        change_reports.manager_changes(tables, *YEAR),
        change_reports.title_changes(tables, *YEAR),
    ]
    assert rows(log) == sorted([r for p in parts for r in rows(p)], key=str)
    assert dict(log.dtypes)["emp_no"] == dict(log.dtypes)["old_value"] == "string"
    dates = [(r["change_date"], r["emp_no"]) for r in log.collect()]
    assert dates == sorted(dates)
    summary = {tuple(r) for r in change_reports.change_summary(log).collect()}
    assert ("manager_change", 2) in summary and sum(n for _, n in summary) == len(dates)


def test_latest_change_report(tables):
    found = {(r[0], r[2]): tuple(r)[3:] for r in change_reports.latest_change_report(tables, *YEAR).collect()}
    assert found[1, "department_change"] == ("Sales", D(1996, 6, 1))
    assert found[3, "salary_change"] == ("150.00", D(1996, 12, 31))
    assert (4, "department_change") not in found


def test_value_report_keeps_equal_values(tables):
    found = rows(change_reports.value_change_report(tables, *YEAR))
    assert (2, "Bob Two", "department_change", "Sales", "Sales", D(1996, 1, 1)) in found
    assert (2, "Bob Two", "salary_change", "100.00", "100.00", D(1996, 6, 1)) in found
    assert (1, "Ada One", "salary_change", "200.00", "300.00", D(1996, 1, 1)) in found
    inside = rows(change_reports.value_change_report(tables, *YEAR, look_back="period"))
    assert set(inside) < set(found)


def test_value_report_drops_stays_in_unknown_departments(spark):
    given = company(
        spark,
        dept_emp=(
            [
                (1, "gone", D(1995, 1, 1), D(1996, 1, 1)),
                (1, "d1", D(1996, 1, 1), D(1996, 2, 1)),
                (1, "gone", D(1996, 2, 1), OPEN),
            ],
            STAY,
        ),
    )
    found = change_reports.value_change_report(given, *YEAR).filter(
        "change_type = 'department_change'"
    )
    assert rows(found) == [
        (1, "Ada One", "department_change", None, "Sales", D(1996, 1, 1)),
    ]
