"""The six tables: two entity tables and four interval histories."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ENTITY_TABLES = ("employees", "departments")
HISTORY_TABLES = ("dept_emp", "dept_manager", "salaries", "titles")
TABLES = ENTITY_TABLES + HISTORY_TABLES

# Optional column of a history table that tells apart rows of one key and day.
RECORD_ID = "rec_id"

_INTERVAL = [StructField("from_date", DateType()), StructField("to_date", DateType())]
_STAY = StructType(
    [StructField("emp_no", LongType(), False), StructField("dept_no", StringType(), False)]
    + _INTERVAL
)
_SCHEMAS = {
    "employees": StructType(
        [
            StructField("emp_no", LongType(), False),
            StructField("birth_date", DateType()),
            StructField("first_name", StringType()),
            StructField("last_name", StringType()),
            StructField("gender", StringType()),
            StructField("hire_date", DateType()),
        ]
    ),
    "departments": StructType(
        [
            StructField("dept_no", StringType(), False),
            StructField("dept_name", StringType()),
        ]
    ),
    "dept_emp": _STAY,
    "dept_manager": _STAY,
    "salaries": StructType(
        [StructField("emp_no", LongType(), False), StructField("salary", DecimalType(10, 2))]
        + _INTERVAL
    ),
    "titles": StructType(
        [StructField("emp_no", LongType(), False), StructField("title", StringType())] + _INTERVAL
    ),
}


def table_schema(table: str, record_id: bool = False) -> StructType:
    """The declared schema, with the record id added to a history on request."""
    fields = list(_SCHEMAS[table].fields)
    if record_id and table in HISTORY_TABLES:
        fields.append(StructField(RECORD_ID, LongType()))
    return StructType(fields)


def history_order(columns: list[str], *values: str) -> list[str]:
    """Order within a key: start date, then record id or else the other columns."""
    tie_break = [RECORD_ID] if RECORD_ID in columns else ["to_date", *values]
    return ["from_date", *tie_break]
