"""Cleaning rules of the six tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureframe.functions import close_end, to_day
from tenureframe.functions.dates import DateLike
from tenureframe.operators import dedupe_by_key

# Defaults for missing text, and what counts as valid.
EMPLOYEE_DEFAULTS = {"first_name": "UNKNOWN", "last_name": "UNKNOWN", "gender": "U"}
DEPARTMENT_DEFAULTS = {"dept_name": "DEPARTMENT_UNKNOWN"}
TITLE_DEFAULTS = {"title": "TITLE_UNKNOWN"}
GENDERS = ("M", "F")
OTHER_GENDER = "U"
SALARY_TYPE = "decimal(10,2)"
SALARY_RANGE = (1000, 1000000)

STAY_KEY = ("emp_no", "dept_no")


def with_days(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: to_day(c) for c in columns})


def valid_intervals(df: DataFrame) -> DataFrame:
    """Keep rows that do not end before they start; a missing bound goes out."""
    return df.filter(F.col("from_date") <= F.col("to_date"))


def close_open_intervals(
    df: DataFrame, as_of: DateLike | None = None, columns: Sequence[str] = ("to_date",)
) -> DataFrame:
    return df.withColumns({c: close_end(c, as_of) for c in columns})


def in_domain(column: str, allowed: Sequence[str], other: str) -> Column:
    """The value if allowed; anything else, NULL included, becomes ``other``."""
    return F.when(F.col(column).isin(*allowed), F.col(column)).otherwise(F.lit(other))


def clean_employees(df: DataFrame) -> DataFrame:
    filled = with_days(df, "birth_date", "hire_date").fillna(EMPLOYEE_DEFAULTS)
    single = dedupe_by_key(filled, ["emp_no"])
    return single.withColumn("gender", in_domain("gender", GENDERS, OTHER_GENDER))


def clean_departments(df: DataFrame) -> DataFrame:
    named = df.withColumn("dept_name", F.trim("dept_name")).fillna(DEPARTMENT_DEFAULTS)
    return dedupe_by_key(named, ["dept_no"])


def clean_stays(
    df: DataFrame, as_of: DateLike | None = None, keys: Sequence[str] = STAY_KEY
) -> DataFrame:
    """Employee or manager stays in departments.

    The default key leaves one stay per employee and department, the latest; add
    ``from_date`` to keep returns to a former department.
    """
    valid = valid_intervals(with_days(df, "from_date", "to_date"))
    return close_open_intervals(dedupe_by_key(valid, list(keys)), as_of)


def clean_salaries(df: DataFrame, as_of: DateLike | None = None) -> DataFrame:
    typed = with_days(df, "from_date", "to_date").withColumn(
        "salary", F.col("salary").try_cast(SALARY_TYPE)
    )
    valid = valid_intervals(typed.filter(F.col("salary").between(*SALARY_RANGE)))
    return close_open_intervals(dedupe_by_key(valid, ["emp_no", "from_date"]), as_of)


def clean_titles(df: DataFrame, as_of: DateLike | None = None) -> DataFrame:
    """Missing titles are filled after de-duplication."""
    typed = with_days(df, "from_date", "to_date").withColumn(
        "title", F.initcap(F.trim("title"))
    )
    single = dedupe_by_key(valid_intervals(typed), ["emp_no", "title", "from_date"])
    return close_open_intervals(single.fillna(TITLE_DEFAULTS), as_of)


def clean_all_tables(
    raw: Mapping[str, DataFrame],
    as_of: DateLike | None = None,
    stay_keys: Sequence[str] = STAY_KEY,
) -> dict[str, DataFrame]:
    return {
        "employees": clean_employees(raw["employees"]),
        "departments": clean_departments(raw["departments"]),
        "dept_emp": clean_stays(raw["dept_emp"], as_of, stay_keys),
        "dept_manager": clean_stays(raw["dept_manager"], as_of, stay_keys),
        "salaries": clean_salaries(raw["salaries"], as_of),
        "titles": clean_titles(raw["titles"], as_of),
    }
