"""The six HR tables derived from the ``orders`` and ``customer`` test tables.

Customer stands for employee, order for history record, order priority for
department, order status for title and order total for salary. The derived
tables are written once per session to the shared scratch folder and read back,
as a cleaned zone would be: later plans start from a Parquet scan with pushdown
and known sizes, and a lost executor costs a re-read, not a re-derivation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenureframe.functions import OPEN_END
from tenureframe.operators import with_neighbour
from tenureframe.session import scratch_path
from tenureframe.sources.schemas import HISTORY_TABLES, table_schema

_written: dict[tuple[str, str], str] = {}


def _history(orders: DataFrame) -> DataFrame:
    """One row per order, valid until the customer's next order."""
    records = orders.select(
        F.col("o_custkey").alias("emp_no"),
        F.col("o_orderkey").alias("rec_id"),
        F.substring("o_orderpriority", 1, 1).alias("dept_no"),
        F.col("o_orderstatus").alias("title"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("salary"),
        F.to_date("o_orderdate").alias("from_date"),
    )
    linked = with_neighbour(
        records, ["emp_no"], ["from_date", "rec_id"], {"_next": "from_date"}, direction="next"
    )
    left = F.col("emp_no") % 4 == 0
    return linked.withColumn(
        "to_date",
        F.when(F.col("_next").isNotNull(), F.col("_next"))
        .when(left, F.date_add("from_date", 90))
        .otherwise(F.lit(OPEN_END)),
    ).drop("_next")


def _employees(customer: DataFrame, history: DataFrame) -> DataFrame:
    hired = history.groupBy("emp_no").agg(F.min("from_date").alias("hire_date"))
    key = F.col("c_custkey")
    name = F.col("c_name")
    return (
        customer.select(
            key.alias("emp_no"),
            F.date_add(F.lit("1950-01-01").cast("date"), (key % 15000).cast("int")).alias(
                "birth_date"
            ),
            F.split_part(name, F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(name, F.lit("#"), F.lit(2)).alias("last_name"),
            F.substring("c_mktsegment", 1, 1).alias("gender"),
        )
        .join(hired, "emp_no", "left")
    )


def _departments(orders: DataFrame) -> DataFrame:
    priority = F.col("o_orderpriority")
    return orders.select(
        F.substring(priority, 1, 1).alias("dept_no"),
        F.expr("substring(o_orderpriority, 3)").alias("dept_name"),
    ).distinct()


def _write_tables(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "hr-tables")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    # In order of date, so that a period is read without the rest.
    history = _history(orders).repartitionByRange("from_date", "rec_id")
    history.sortWithinPartitions("from_date", "rec_id").write.parquet(f"{base}/history")
    history = spark.read.parquet(f"{base}/history")
    _employees(customer, history).write.parquet(f"{base}/employees")
    _departments(orders).write.parquet(f"{base}/departments")
    return base


def tables_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the derived tables, written on first use in this session."""
    where = (spark.sparkContext.applicationId, sf_dir)
    if where not in _written:
        _written[where] = _write_tables(spark, sf_dir)
    return _written[where]


def hr_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six tables. The histories are column subsets of one stored table."""
    base = tables_path(spark, sf_dir)

    def scan(folder: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{base}/{folder}")

    tables = {
        name: scan(name, table_schema(name)) for name in ("employees", "departments")
    }
    for name in HISTORY_TABLES:
        tables[name] = scan("history", table_schema(name, record_id=True))
    # The data model: every hundredth record is a manager's term.
    tables["dept_manager"] = tables["dept_manager"].filter(F.col("rec_id") % 100 == 0)
    return tables


def faulty_hr_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same tables with faults set by key arithmetic, for cleaning and checks."""
    tables = hr_tables(spark, sf_dir)
    employees, rec = tables["employees"], F.col("rec_id")

    def every(key: str, step: int):
        return F.col(key) % step == 0

    def ends(df: DataFrame, reversed_step: int, null_step: int | None = None) -> DataFrame:
        end = F.when(rec % reversed_step == 0, F.date_sub("from_date", 1))
        if null_step is not None:
            end = end.when(rec % null_step == 0, F.lit(None).cast("date"))
        return df.withColumn("to_date", end.otherwise(F.col("to_date")))

    money = "decimal(10,2)"
    return {
        "employees": employees.withColumns(
            {
                "birth_date": F.when(
                    every("emp_no", 53), F.lit("1890-01-01").cast("date")
                ).otherwise(F.col("birth_date")),
                "first_name": F.when(~every("emp_no", 17), F.col("first_name")),
                "gender": F.when(~every("emp_no", 19), F.col("gender")),
            }
        ).unionByName(employees.filter(every("emp_no", 10))),
        "departments": tables["departments"].withColumn(
            "dept_name",
            F.when(F.col("dept_no") != "4", F.concat(F.lit("  "), "dept_name", F.lit(" "))),
        ),
        "dept_emp": ends(tables["dept_emp"], 101, 103),
        "dept_manager": ends(tables["dept_manager"], 700),
        "salaries": tables["salaries"].withColumn(
            "salary",
            F.when(rec % 107 == 0, F.lit(5).cast(money))
            .when(rec % 109 == 0, F.lit(2000000).cast(money))
            .when(rec % 113 == 0, F.lit(None).cast(money))
            .otherwise(F.col("salary")),
        ),
        "titles": tables["titles"].withColumn(
            "title",
            F.when(rec % 127 == 0, F.lit(None).cast("string"))
            .when(F.col("title") == "F", F.lit("  senior  ENGINEER "))
            .when(F.col("title") == "O", F.lit("staff"))
            .otherwise(F.lit("Technique Leader")),
        ),
    }
