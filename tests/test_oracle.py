"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle_compare import TESTDATA, duck, spark_rows, sql_rows

QUERIES = entry_points.QUERIES
ORACLE = entry_points.ORACLE
UNWANTED = ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")
SF_DIR = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, rows = spark_rows(df)
    expected_columns, expected = sql_rows(connection, ORACLE[name])
    assert columns == expected_columns
    assert rows, "a query without rows proves nothing"
    assert rows == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in UNWANTED:
        assert node not in plan


def test_entry(spark):
    report = entry_points.entry(spark)
    assert report.count() == 150


# Row counts at sf0.01, measured once and written down with the fixtures.
KNOWN_COUNTS = {
    "dept_rotation": 5,
    "salary_trend": 105,
    "most_senior": 10,
    "change_log_dept": 3391,
    "change_log_manager": 46,
    "interval_years": 15000,
    "clean_employees": 1500,
    "share_within_group": 25,
}
KNOWN_VALUES = {
    "SELECT count(*) FROM ({monthly_change_report}) WHERE change_type = 'department_change'": 183,
    "SELECT count(*) FROM ({monthly_change_report_period}) "
    "WHERE change_type = 'department_change'": 7,
    "SELECT violations FROM ({dq_suite}) WHERE rule = 'interval' AND table_name = 'dept_emp'": 149,
    "SELECT violations FROM ({dq_suite}) WHERE rule = 'null' AND table_name = 'dept_emp' "
    "AND column_name = 'to_date'": 144,
    "SELECT violations FROM ({dq_range_check})": 277,
    "SELECT sum(violations) FROM ({dq_domain_check})": 934,
    "SELECT violations FROM ({dq_date_range_check})": 29,
}


@pytest.mark.parametrize("name", KNOWN_COUNTS)
def test_known_row_counts(connection, name):
    found = connection.execute(f"SELECT count(*) FROM ({ORACLE[name]})").fetchone()[0]
    assert found == KNOWN_COUNTS[name]


@pytest.mark.parametrize("query", KNOWN_VALUES)
def test_known_values(connection, query):
    found = connection.execute(query.format_map(ORACLE)).fetchone()[0]
    assert found == KNOWN_VALUES[query]
