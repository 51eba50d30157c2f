"""Data quality checks. Each returns a DataFrame and aggregates a table once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tenureframe.functions import row_count
from tenureframe.functions.dates import DateLike, as_date
from tenureframe.operators import values_at
from tenureframe.plans.cleaning import GENDERS, SALARY_RANGE

# Fixed value: birth dates outside these are reported.
BIRTH_DATE_RANGE = ("1900-01-01", "2023-12-31")

# Fixed value: how many offending rows a check shows.
SAMPLE_ROWS = 5

# Rule name, column it is about, and the condition that marks a violation.
Rule = tuple[str, str, Column]


def _missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        missing = missing | F.isnan(column)
    return missing


def _outside(column: str, low, high) -> Column:
    """NULL is not outside."""
    return ~F.col(column).between(low, high)


def _outside_dates(column: str, low: DateLike, high: DateLike) -> Column:
    return (F.col(column) < as_date(low)) | (F.col(column) > as_date(high))


def _not_in(column: str, allowed: Sequence[str]) -> Column:
    return ~F.col(column).isin(*allowed)


def _reversed(start: str, end: str) -> Column:
    return F.col(end) < F.col(start)


def _count_violations(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules of a table in one aggregate, then one row per rule."""
    counts = df.agg(*[F.count_if(rule[2]).alias(f"r{i}") for i, rule in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("rule"),
            F.lit(column).alias("column_name"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, (name, column, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_rules(df: DataFrame) -> list[Rule]:
    return [("null", c, _missing(df, c)) for c in df.columns]


def table_rules(df: DataFrame, table: str) -> list[Rule]:
    """Nulls everywhere, plus what the table's columns and name ask for."""
    rules = null_rules(df)
    if {"from_date", "to_date"} <= set(df.columns):
        rules.append(("interval", "to_date", _reversed("from_date", "to_date")))
    if table == "employees":
        rules.append(("domain", "gender", _not_in("gender", GENDERS)))
        rules.append(("date_range", "birth_date", _outside_dates("birth_date", *BIRTH_DATE_RANGE)))
    if table == "salaries":
        rules.append(("range", "salary", _outside("salary", *SALARY_RANGE)))
    return rules


def check_nulls(df: DataFrame, table: str) -> DataFrame:
    """NULL count per column; NaN counts too in float columns."""
    return _count_violations(df, table, null_rules(df)).drop("rule")


def check_domain(
    df: DataFrame, column: str = "gender", allowed: Sequence[str] = GENDERS
) -> DataFrame:
    """Each value outside the domain and its rows; NULL is not outside."""
    return (
        df.filter(_not_in(column, allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(row_count().alias("violations"))
    )


def check_range(df: DataFrame, table: str, column: str, low, high) -> DataFrame:
    return _count_violations(df, table, [("range", column, _outside(column, low, high))])


def profile_out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the values outside.

    Quartiles are values that occur, found by radix narrowing: memory does not grow with
    the number of distinct values.
    """
    value = F.col(column).cast("double")
    kind = df.schema[column].dataType
    # Text and very long decimals are ranked as the doubles that are shown.
    ranked = isinstance(kind, NumericType) and getattr(kind, "precision", 0) <= 18
    outside = df.filter(_outside(column, low, high)).select(
        (F.col(column) if ranked else value).alias(column)
    )
    quartiles = values_at(outside, column, (0.25, 0.5, 0.75)).scalar()
    profile = outside.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return profile.withColumn("quartiles", quartiles).select(
        *("count", "mean", "stddev", "min"),
        *[F.get("quartiles", F.lit(i)).cast("double").alias(f"q{p}") for i, p in enumerate((25, 50, 75))],
        "max",
    )


def check_date_range(
    df: DataFrame, table: str, column: str, low: DateLike, high: DateLike
) -> DataFrame:
    return _count_violations(df, table, [("date_range", column, _outside_dates(column, low, high))])


def sample_out_of_date_range(
    df: DataFrame, column: str, low: DateLike, high: DateLike, order: Sequence[str] = ()
) -> DataFrame:
    """The first few rows whose date lies outside."""
    return (
        df.filter(_outside_dates(column, low, high)).orderBy(column, *order).limit(SAMPLE_ROWS)
    )


def check_intervals(
    df: DataFrame, table: str, start: str = "from_date", end: str = "to_date"
) -> DataFrame:
    """Rows that end before they start, and whether the table passes."""
    counted = _count_violations(df, table, [("interval", end, _reversed(start, end))])
    return counted.withColumn("passed", F.col("violations") == 0)


def sample_reversed_intervals(
    df: DataFrame, start: str = "from_date", end: str = "to_date", order: Sequence[str] = ()
) -> DataFrame:
    """The first few rows that end before they start."""
    return df.filter(_reversed(start, end)).orderBy(start, *order).limit(SAMPLE_ROWS)


def offenders(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What the checks count, shown: invalid values, the profile of pay, sample rows."""
    shown = {
        "employees: gender outside the domain": check_domain(tables["employees"]),
        "employees: birth date outside the range": sample_out_of_date_range(
            tables["employees"], "birth_date", *BIRTH_DATE_RANGE, order=["emp_no"]
        ),
        "salaries: profile of pay outside the range": profile_out_of_range(
            tables["salaries"], "salary", *SALARY_RANGE
        ),
    }
    for name, df in tables.items():
        if {"from_date", "to_date"} <= set(df.columns):
            rest = [c for c in df.columns if c not in ("from_date", "to_date")]
            shown[f"{name}: ends before it starts"] = sample_reversed_intervals(df, order=rest)
    return shown


def check_table(df: DataFrame, table: str) -> DataFrame:
    return _count_violations(df, table, table_rules(df, table))


CHECKS = "table_name string, rule string, column_name string, violations bigint"


def watch_rules(df: DataFrame, table: str) -> tuple[DataFrame, Callable[[], dict]]:
    """The table with every rule counted as its rows pass, and a function that gives the
    counts, and the number of rows, once a write of the table is done."""
    rules, seen = table_rules(df, table), Observation()
    counts = [F.count_if(rule[2]).alias(f"r{i}") for i, rule in enumerate(rules)]

    def values() -> dict:
        found = seen.get
        violations = [[name, column, found[f"r{i}"]] for i, (name, column, _) in enumerate(rules)]
        return {"rows": found["rows"], "violations": violations}

    return df.observe(seen, row_count().alias("rows"), *counts), values


def checks_of(spark: SparkSession, manifest: Mapping) -> DataFrame:
    """The checks of a version that was written under ``watch_rules``; no table is read."""
    rows = [
        (table, rule, column, violations)
        for table, facts in manifest["parts"].items()
        for rule, column, violations in facts["violations"]
    ]
    return spark.createDataFrame(rows, CHECKS)


def check_all_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every rule of every table: (table_name, rule, column_name, violations)."""
    return reduce(DataFrame.unionByName, [check_table(df, t) for t, df in tables.items()])
