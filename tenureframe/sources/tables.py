"""Read the six tables from a database or from Parquet, lazily."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureframe.functions import between_dates
from tenureframe.functions.dates import DateLike
from tenureframe.sources.buckets import BUCKET_KEY, read_buckets
from tenureframe.sources.schemas import HISTORY_TABLES, TABLES, table_schema
from tenureframe.versions import Versions


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        options = {
            "url": self.url,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }
        if self.user:
            options |= {"user": self.user, "password": self.password}
        return options


@dataclass(frozen=True)
class JdbcSplit:
    """Range split of a table over ``partitions`` parallel reads."""

    column: str
    lower: int | dt.date
    upper: int | dt.date
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_jdbc_table(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    split: JdbcSplit | None = None,
) -> DataFrame:
    """One table; without a split it is read by a single task."""
    options = connection.options() | {"dbtable": table}
    if split is not None:
        options |= split.options()
    return spark.read.format("jdbc").options(**options).load()


def split_column(table: str) -> str | None:
    """Histories are split by date, so that one long employee history spreads."""
    if table in HISTORY_TABLES:
        return "from_date"
    return "emp_no" if table == "employees" else None


def jdbc_split(
    spark: SparkSession, connection: JdbcConnection, table: str, partitions: int
) -> JdbcSplit | None:
    """Ask the database for the split column's range: one row comes back."""
    column = split_column(table)
    if column is None:
        return None
    bounds = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    lower, upper = read_jdbc_table(spark, connection, bounds).first()
    return None if lower is None else JdbcSplit(column, lower, upper, partitions)


def read_jdbc_tables(
    spark: SparkSession,
    connection: JdbcConnection,
    tables: Iterable[str] = TABLES,
    partitions: int = 16,
) -> dict[str, DataFrame]:
    """Every configured table, each in ``partitions`` parallel reads."""
    return {
        table: read_jdbc_table(
            spark,
            connection,
            table,
            jdbc_split(spark, connection, table, partitions) if partitions > 1 else None,
        )
        for table in tables
    }


def read_parquet_tables(
    spark: SparkSession,
    base_path: str,
    tables: Iterable[str] = TABLES,
    record_id: bool = False,
    schemas: Mapping[str, object] | None = None,
) -> dict[str, DataFrame]:
    """Tables saved one folder each, read with the declared schemas: all of the last
    published version, if the path has versions, in its buckets, if it has them."""
    base = base_path.rstrip("/")
    manifest = Versions(spark, base).read() or {}
    folder = f"{base}/{manifest['folder']}" if manifest else base
    buckets = manifest.get("buckets")

    def read(table: str) -> DataFrame:
        schema = (schemas or {}).get(table) or table_schema(table, record_id)
        if buckets and BUCKET_KEY in schema.names:
            return read_buckets(spark, f"{folder}/{table}", schema, buckets)
        return spark.read.schema(schema).parquet(f"{folder}/{table}")

    return {table: read(table) for table in tables}


def period_rows(
    df: DataFrame, start: DateLike, end: DateLike, column: str = "from_date"
) -> DataFrame:
    """Rows that start in the period; the filter reaches Parquet and JDBC scans."""
    return df.filter(between_dates(F.col(column), start, end))
