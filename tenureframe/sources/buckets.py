"""Tables in buckets of employee numbers.

All rows of an employee lie in one bucket, and the buckets of all tables are cut alike, so
a window or an aggregate per employee, and a join by employee, run inside the buckets: no
rows are shuffled. A bucket is read by one task. That suits the cleaned zone, where an
employee has at most one row per date and value; raw histories, in which one employee may
hold a third of all rows, are better left by date.

Spark knows of buckets through its catalog only. The files are the table: a reader
registers them under a new name of its own session, and dropping it leaves the files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKET_KEY = "emp_no"


def _new_name() -> str:
    return f"tenureframe_{uuid.uuid4().hex}"


def write_buckets(
    df: DataFrame, path: str, buckets: int, file_format: str = "parquet", key: str = BUCKET_KEY
) -> None:
    """The rows in ``buckets`` files, each sorted by key and start; a new path."""
    order = [key, *[c for c in ("from_date",) if c in df.columns]]
    name = _new_name()
    arranged = df.repartition(buckets, key).write.format(file_format)
    arranged.bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_buckets(
    spark: SparkSession,
    path: str,
    schema: StructType,
    buckets: int,
    file_format: str = "parquet",
    key: str = BUCKET_KEY,
) -> DataFrame:
    """What ``write_buckets`` wrote, with as many buckets as were written."""
    name = _new_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING {file_format} "
        f"CLUSTERED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
