"""Reports on what changed in a period.

Values of different kinds share one column, so numbers become text before the
kinds are put together: ``emp_no`` where a row has none to show, salaries with
two decimals. The kinds are put together first and meet the employees once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.functions.dates import DateLike
from tenureframe.operators import (
    detect_changes,
    first_last_in_period,
    latest_per_key,
)
from tenureframe.sources.schemas import RECORD_ID, history_order
from tenureframe.sources.tables import period_rows

Tables = Mapping[str, DataFrame]

# The kinds of change, and the text for what does not apply.
DEPARTMENT_CHANGE = "department_change"
SALARY_CHANGE = "salary_change"
MANAGER_CHANGE = "manager_change"
TITLE_CHANGE = "title_change"
NOT_APPLICABLE = "N/A"

# The columns of the reports, as they are written to CSV.
LATEST_SCHEMA = (
    "emp_no bigint, full_name string, change_type string, new_value string, change_date date"
)
VALUE_SCHEMA = (
    "emp_no bigint, full_name string, change_type string, old_value string, new_value string, "
    "change_date date"
)

_VALUES = {"dept_emp": "dept_no", "salaries": "salary", "titles": "title"}
_KINDS = {
    "dept_emp": DEPARTMENT_CHANGE,
    "salaries": SALARY_CHANGE,
    "titles": TITLE_CHANGE,
}


def _text(value: str) -> Column:
    return F.col(value).cast("string")


def _salary_text(value: str) -> Column:
    return F.col(value).cast("decimal(10,2)").cast("string")


def _order(tables: Tables, table: str) -> list[str]:
    return history_order(tables[table].columns, _VALUES[table])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _department_names(tables: Tables, code: str, name: str) -> DataFrame:
    return tables["departments"].select(
        F.col("dept_no").alias(code), F.col("dept_name").alias(name)
    )


# Change log: one row per change, with employee and department names.


def _log_rows(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    blank = F.lit(NOT_APPLICABLE)
    return df.select(
        "emp_no",
        columns.get("dept_name", blank).alias("dept_name"),
        columns["change_date"].alias("change_date"),
        F.lit(kind).alias("change_type"),
        columns.get("old_value", blank).alias("old_value"),
        columns.get("new_value", blank).alias("new_value"),
    )


def _department_log(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    order = _order(tables, "dept_emp")
    moved = detect_changes(tables["dept_emp"], ["emp_no"], "dept_no", order, start, end)
    named = moved.join(_department_names(tables, "dept_no", "to_name"), "dept_no").join(
        _department_names(tables, "prev_dept_no", "from_name"), "prev_dept_no"
    )
    return _log_rows(
        named,
        DEPARTMENT_CHANGE,
        dept_name=F.col("to_name"),
        change_date=F.col("from_date"),
        old_value=F.col("from_name"),
        new_value=F.col("to_name"),
    )


def _salary_log(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    ends = first_last_in_period(
        tables["salaries"], ["emp_no"], "salary", _order(tables, "salaries"), start, end
    )
    return _log_rows(
        ends,
        SALARY_CHANGE,
        change_date=F.col("change_date"),
        old_value=_salary_text("old_salary"),
        new_value=_salary_text("new_salary"),
    )


def _manager_log(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    terms = period_rows(tables["dept_manager"], start, end)
    return _log_rows(
        terms.join(tables["departments"], "dept_no"),
        MANAGER_CHANGE,
        dept_name=F.col("dept_name"),
        change_date=F.col("from_date"),
    )


def _title_log(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    started = period_rows(tables["titles"], start, end)
    return _log_rows(
        started, TITLE_CHANGE, change_date=F.col("from_date"), new_value=F.col("title")
    )


def _with_names(log: DataFrame, tables: Tables) -> DataFrame:
    """Employee names by number; a manager row then hides the number."""
    people = tables["employees"].select("emp_no", "first_name", "last_name")
    hidden = F.col("change_type") == MANAGER_CHANGE
    return log.join(people, "emp_no").select(
        F.when(hidden, NOT_APPLICABLE).otherwise(_text("emp_no")).alias("emp_no"),
        F.concat_ws(" ", "first_name", "last_name").alias("employee_name"),
        "dept_name",
        "change_date",
        "change_type",
        "old_value",
        "new_value",
    )


def department_changes(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """Moves to another department, compared with the previous stay of all time."""
    return _with_names(_department_log(tables, start, end), tables)


def salary_changes(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """First and last salary of the period where they differ."""
    return _with_names(_salary_log(tables, start, end), tables)


def manager_changes(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """Manager terms that start in the period."""
    return _with_names(_manager_log(tables, start, end), tables)


def title_changes(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """Titles that start in the period."""
    return _with_names(_title_log(tables, start, end), tables)


def change_log(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """All four kinds, by date and then employee number as text."""
    log = _union(
        [
            _department_log(tables, start, end),
            _salary_log(tables, start, end),
            _manager_log(tables, start, end),
            _title_log(tables, start, end),
        ]
    )
    # The further sort keys keep equal dates divisible between tasks.
    return _with_names(log, tables).orderBy(
        "change_date", "emp_no", "change_type", "employee_name", "new_value"
    )


def change_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("change_type").agg(row_count().alias("count"))


# Value reports: new, or previous and new, value per employee and kind.


def _with_full_name(changes: DataFrame, tables: Tables) -> DataFrame:
    people = tables["employees"].select(
        "emp_no", F.concat("first_name", F.lit(" "), "last_name").alias("full_name")
    )
    values = [c for c in ("old_value", "new_value") if c in changes.columns]
    return changes.join(people, "emp_no").select(
        "emp_no", "full_name", "change_type", *values, "change_date"
    )


def latest_change_report(tables: Tables, start: DateLike, end: DateLike) -> DataFrame:
    """Per employee and kind, the newest row that starts in the period."""

    def newest(table: str) -> DataFrame:
        inside = period_rows(tables[table], start, end)
        return latest_per_key(inside, ["emp_no"], _order(tables, table))

    def rows(df: DataFrame, table: str, value: Column) -> DataFrame:
        return df.select(
            "emp_no",
            F.lit(_KINDS[table]).alias("change_type"),
            value.alias("new_value"),
            F.col("from_date").alias("change_date"),
        )

    moves = newest("dept_emp").join(tables["departments"], "dept_no")
    changes = _union(
        [
            rows(moves, "dept_emp", F.col("dept_name")),
            rows(newest("salaries"), "salaries", _salary_text("salary")),
            rows(newest("titles"), "titles", F.col("title")),
        ]
    )
    return _with_full_name(changes, tables)


def values_by_kind(tables: Tables) -> DataFrame:
    """The three histories in one, so that one shuffle serves all of them."""
    tie_break = "to_date" if "to_date" in _order(tables, "dept_emp") else RECORD_ID
    return _union(
        [
            tables[table].select(
                "emp_no",
                "from_date",
                tie_break,
                F.lit(kind).alias("change_type"),
                _text(_VALUES[table]).alias("value"),
            )
            for table, kind in _KINDS.items()
        ]
    )


def value_change_report(
    tables: Tables,
    start: DateLike,
    end: DateLike,
    look_back: str = "full",
    before: DataFrame | None = None,
) -> DataFrame:
    """Previous and new value of every row of the period that has a previous one.

    Equal values are kept. ``look_back="period"`` knows only rows of the period,
    so a previous value from before it is lost. A stay in a department that does not
    exist is left out; as a previous value it is NULL.

    ``before`` is the last row per employee and kind before the period, in the columns of
    ``values_by_kind``, if it is known: earlier history is then not read.

    Values are compared as codes; names are looked up for the rows of the result.
    """
    history = values_by_kind(tables)
    changes = detect_changes(
        history,
        ["emp_no", "change_type"],
        "value",
        history_order(history.columns, "value"),
        start,
        end,
        only_different=False,
        look_back=look_back,
        before=before,
    )
    moves = (
        changes.filter(F.col("change_type") == DEPARTMENT_CHANGE)
        .join(_department_names(tables, "value", "new_value"), "value")
        .join(_department_names(tables, "prev_value", "old_value"), "prev_value", "left")
    )
    salary = F.col("change_type") == SALARY_CHANGE

    def shown(value: str) -> Column:
        text = F.col(value).try_cast("decimal(10,2)").cast("string")
        return F.when(salary, text).otherwise(F.col(value))

    others = changes.filter(F.col("change_type") != DEPARTMENT_CHANGE).withColumns(
        {"old_value": shown("prev_value"), "new_value": shown("value")}
    )
    columns = [
        "emp_no",
        "change_type",
        "old_value",
        "new_value",
        F.col("from_date").alias("change_date"),
    ]
    both = moves.select(*columns).unionByName(others.select(*columns))
    return _with_full_name(both, tables).orderBy(
        "change_date", "emp_no", "change_type", "new_value"
    )
