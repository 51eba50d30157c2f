"""Reports on departments, tenure, pay and titles.

``tables`` maps table names to DataFrames. Small dimension tables are left to
Spark's own size check: broadcast below the threshold, shuffled above it. Rows
of one employee or department are summed before they meet a join or a distinct
count, so that a key with very many rows shrinks inside the map tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.functions import (
    as_date,
    interval_days,
    interval_years,
    is_open,
    ratio,
    round_half_up,
    row_count,
)
from tenureframe.functions.dates import DAYS_PER_YEAR, OPEN_END, DateLike
from tenureframe.operators import (
    active_at,
    collapse,
    dedupe_by_key,
    join_as_of_interval,
    latest_per_key,
    max_date_rows,
    pivot_values,
    share_within_group,
)
from tenureframe.sources.schemas import RECORD_ID

Tables = Mapping[str, DataFrame]

# The names of the output columns and the labels in this module.


def _latest_by_end(history: DataFrame, value: str) -> DataFrame:
    """The row of each employee with the latest end, then latest start."""
    tie_break = [RECORD_ID] if RECORD_ID in history.columns else [value]
    return latest_per_key(history, ["emp_no"], ["to_date", "from_date", *tie_break])


def department_turnover(tables: Tables) -> DataFrame:
    """Employees with a closed stay among all who ever worked in the department."""
    left = F.max(F.col("to_date") < F.lit(OPEN_END))
    per_employee = tables["dept_emp"].groupBy("dept_no", "emp_no").agg(left.alias("left"))
    per_department = per_employee.groupBy("dept_no").agg(
        F.count_if("left").alias("cantidad_salidos"), row_count().alias("cantidad_total")
    )
    rate = ratio(F.col("cantidad_salidos"), F.col("cantidad_total")) * 100
    return (
        per_department.filter(F.col("cantidad_salidos") > 0)
        .join(tables["departments"], "dept_no")
        .select(
            "dept_no",
            F.col("dept_name").alias("nombre_departamento"),
            "cantidad_salidos",
            "cantidad_total",
            round_half_up(rate).alias("tasa_rotacion_porcentual"),
        )
        .orderBy(F.desc("tasa_rotacion_porcentual"), "dept_no")
    )


def open_stays_by_gender(tables: Tables) -> DataFrame:
    """Open stays counted per department and gender."""
    open_stays = (
        tables["dept_emp"]
        .filter(is_open("to_date"))
        .groupBy("emp_no", "dept_no")
        .agg(row_count().alias("stays"))
    )
    return (
        open_stays.join(tables["employees"].select("emp_no", "gender"), "emp_no")
        .groupBy("dept_no", "gender")
        .agg(F.sum("stays").alias("stays"))
        .join(tables["departments"], "dept_no")
    )


def gender_disparity(tables: Tables) -> DataFrame:
    """Gap between the shares of men and women among a department's open stays.

    A department without one of the two has no gap and ranks last; its label is
    the one for women, as nothing compares greater than NULL.
    """
    shares = share_within_group(
        open_stays_by_gender(tables), "dept_name", "gender", weight="stays"
    )
    wide = pivot_values(shares, "dept_name", "gender", "share", {"M": "men", "F": "women"})
    gap = F.abs(F.col("men") - F.col("women"))
    # One row per department is left, so a ranking over all of them is small.
    rank = F.rank().over(Window.orderBy(F.col("gap").desc_nulls_last()))
    return (
        wide.withColumn("gap", gap)
        .select(
            F.col("dept_name").alias("departamento"),
            round_half_up(F.col("men")).alias("% Hombres"),
            round_half_up(F.col("women")).alias("% Mujeres"),
            round_half_up(F.col("gap")).alias("Diferencia %"),
            F.when(F.col("men") > F.col("women"), "Masculino")
            .otherwise("Femenino")
            .alias("Género predominante"),
            rank.cast("bigint").alias("Ranking Disparidad"),
        )
        .orderBy("Ranking Disparidad", "departamento")
    )


def manager_retention_rank(tables: Tables, as_of: DateLike | None = None) -> DataFrame:
    """Mean years of the stays in each manager's department, worst rank first.

    The figure belongs to the department, so it is computed once per department
    and the ranking over managers comes from counting managers per department:
    the only window without a key runs over departments.
    """
    days = interval_days("from_date", "to_date", as_of)
    per_employee = (
        tables["dept_emp"]
        .select("dept_no", "emp_no", days.alias("days"))
        .filter(F.col("days") > 0)
        .groupBy("dept_no", "emp_no")
        .agg(F.sum("days").alias("days"), row_count().alias("stays"))
    )
    figures = per_employee.groupBy("dept_no").agg(
        (ratio(F.sum("days"), F.sum("stays")) / DAYS_PER_YEAR).alias("years"),
        row_count().alias("employee_count"),
    )
    managers = (
        tables["dept_manager"]
        .select("emp_no", "dept_no")
        .distinct()
        .join(tables["employees"].select("emp_no", "first_name", "last_name"), "emp_no")
    )
    sizes = managers.groupBy("dept_no").agg(row_count().alias("managers"))
    up_to_peers = F.sum("managers").over(Window.orderBy(F.desc("years")))
    peers = F.sum("managers").over(Window.partitionBy("years"))
    departments = (
        figures.join(sizes, "dept_no")
        .join(tables["departments"], "dept_no")
        .withColumn("retention_rank", up_to_peers - peers + 1)
    )
    return (
        managers.join(departments, "dept_no")
        .select(
            F.col("emp_no").alias("manager_id"),
            F.col("first_name").alias("manager_name"),
            F.col("last_name").alias("manager_last_name"),
            F.col("dept_name").alias("department"),
            round_half_up(F.col("years")).alias("avg_retention_years"),
            "employee_count",
            "retention_rank",
        )
        .orderBy(F.desc("retention_rank"), "manager_id", "department")
    )


def most_senior(tables: Tables, as_of: DateLike | None = None, n: int = 10) -> DataFrame:
    """The longest serving employees with an open stay.

    Title and department are those of the latest start; ties give several rows. Every
    chosen employee gives at least one row, so the first ``n`` employees are enough,
    and of each of them the first ``n`` distinct titles and departments, with counts.
    """
    stays = tables["dept_emp"].select("emp_no", "dept_no", "from_date")
    placed = max_date_rows(stays, ["emp_no"]).join(tables["departments"], "dept_no")
    titled = tables["titles"].filter(F.col("from_date").isNotNull())
    employed = tables["dept_emp"].filter(is_open("to_date"))
    years = F.datediff(as_date(as_of), F.col("hire_date")) / float(DAYS_PER_YEAR)
    first = tables["employees"].withColumn("seniority", round_half_up(years))
    for needed in (employed, titled, placed):
        first = first.join(needed.select("emp_no").distinct(), "emp_no", "left_semi")
    order = [F.desc("seniority"), "emp_no"]
    first = first.orderBy(*order).limit(n)

    def distinct(latest: DataFrame, value: str, count: str) -> DataFrame:
        counted = collapse(latest, ["emp_no", value], count=count)
        place = F.row_number().over(Window.partitionBy("emp_no").orderBy(value))
        return counted.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")

    def of_first(history: DataFrame) -> DataFrame:
        return history.join(first.select("emp_no").distinct(), "emp_no", "left_semi")

    titles = max_date_rows(of_first(titled.select("emp_no", "title", "from_date")), ["emp_no"])
    times = F.least(F.col("n_titles") * F.col("n_stays"), F.lit(n))
    return (
        first.join(distinct(titles, "title", "n_titles"), "emp_no")
        .join(distinct(of_first(placed), "dept_name", "n_stays"), "emp_no")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
        .select(
            "emp_no",
            "first_name",
            "last_name",
            "hire_date",
            "seniority",
            F.col("title").alias("actual_title"),
            F.col("dept_name").alias("actual_dept"),
        )
        .orderBy(*order, "actual_title", "actual_dept")
        .limit(n)
    )


def salary_trend(tables: Tables, closed: str = "both") -> DataFrame:
    """Mean pay and staff per department, title and year of salary start.

    Every salary meets each title and stay that covers its start. All three tables are
    first reduced to one row per distinct value and interval with a count, and the
    products of the counts restore sums and row numbers, so an employee with very many
    rows meets in distinct combinations only. Missing pay counts as staff, but neither
    in the sum nor in the number of salaries.
    """
    salaries = (
        tables["salaries"]
        .filter(F.year("from_date") < 9999)
        .groupBy("emp_no", F.col("from_date").alias("pay_date"))
        .agg(F.sum("salary").alias("salary"), F.count("salary").alias("n_pay"))
    )

    # Names come first: departments that share one are then one group per employee, and
    # one aggregate does for both.
    stays = tables["dept_emp"].join(tables["departments"].select("dept_no", "dept_name"), "dept_no")

    def intervals(history: DataFrame, value: str, name: str) -> DataFrame:
        rows = history.select(
            "emp_no",
            value,
            F.col("from_date").alias(f"{name}_from"),
            F.col("to_date").alias(f"{name}_to"),
        )
        return collapse(rows, rows.columns, count=f"n_{name}")

    joined = salaries
    for table, history, value, name in (
        ("titles", tables["titles"], "title", "title"),
        ("dept_emp", stays, "dept_name", "stay"),
    ):
        joined = join_as_of_interval(
            joined,
            intervals(history, value, name),
            "emp_no",
            "pay_date",
            closed,
            f"{name}_from",
            f"{name}_to",
            sizes_from=tables[table],
        )
    pairs = F.col("n_title") * F.col("n_stay")
    group = ["dept_name", "title", "year_report"]
    return (
        joined.withColumn("year_report", F.year("pay_date").cast("bigint"))
        .groupBy("emp_no", *group)
        .agg(
            F.sum(F.col("salary") * pairs.cast("decimal(18,0)")).alias("pay"),
            F.sum(F.col("n_pay") * pairs).alias("salaries"),
        )
        .groupBy(*group)
        .agg(
            round_half_up(ratio(F.sum("pay"), F.sum("salaries"))).alias("avg_salary"),
            row_count().alias("cantidad_empleados"),
        )
        .withColumnRenamed("dept_name", "departamento")
        .orderBy("departamento", "title", "year_report")
    )


def title_tenure(tables: Tables, as_of: DateLike | None = None) -> DataFrame:
    """Distinct titles per employee and mean years per title row."""
    days = interval_days("from_date", "to_date", as_of)
    per_title = (
        tables["titles"]
        .groupBy("emp_no", "title")
        .agg(F.sum(days).alias("days"), F.count(days).alias("dated"))
    )
    per_employee = per_title.groupBy("emp_no").agg(
        F.count("title").alias("total_titles"),
        (ratio(F.sum("days"), F.sum("dated")) / DAYS_PER_YEAR).alias("avg_years_per_position"),
    )
    return (
        tables["employees"]
        .select("emp_no", "first_name", "last_name")
        .join(per_employee, "emp_no", "left")
        .withColumn("total_titles", F.coalesce("total_titles", F.lit(0)))
        .orderBy(F.desc("total_titles"), "emp_no")
    )


def annual_cost(tables: Tables, as_of: DateLike | None = None) -> DataFrame:
    """Latest salary of the employees in each department on ``as_of``.

    On cleaned tables ``as_of`` must be the date they were cleaned with.
    """
    pay = _latest_by_end(tables["salaries"], "salary").select("emp_no", "salary")
    current = (
        tables["dept_emp"]
        .filter(F.col("to_date") >= as_date(as_of))
        .groupBy("emp_no", "dept_no")
        .agg(row_count().cast("decimal(18,0)").alias("stays"))
    )
    return (
        current.join(pay, "emp_no")
        .groupBy("dept_no")
        .agg(F.sum(F.col("salary") * F.col("stays")).alias("cost"))
        .join(tables["departments"], "dept_no")
        .groupBy("dept_name")
        .agg(F.sum("cost").cast("decimal(38,2)").alias("costo_anual"))
        .orderBy(F.desc("costo_anual"), "dept_name")
    )


def employee_report(tables: Tables, as_of: DateLike | None = None) -> DataFrame:
    """Every employee with latest department, title and salary, and tenure."""
    department = (
        _latest_by_end(tables["dept_emp"], "dept_no")
        .join(tables["departments"], "dept_no", "left")
        .select("emp_no", F.col("dept_name").alias("current_department"))
    )
    title = _latest_by_end(tables["titles"], "title").select(
        "emp_no", F.col("title").alias("current_title")
    )
    pay = _latest_by_end(tables["salaries"], "salary").select(
        "emp_no", F.col("salary").alias("current_salary")
    )
    years = F.datediff(as_date(as_of), F.col("hire_date")) / float(DAYS_PER_YEAR)
    return (
        tables["employees"]
        .join(department, "emp_no", "left")
        .join(title, "emp_no", "left")
        .join(pay, "emp_no", "left")
        .select(
            "emp_no",
            F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
            "current_department",
            "current_title",
            "current_salary",
            "hire_date",
            round_half_up(years).alias("tenure_years"),
        )
    )


def department_moves(tables: Tables, min_rows: int = 2) -> DataFrame:
    """A row per stay of employees with several, with their number of stays.

    The form for raw history: no employee's stays are brought together.
    """
    counted = (
        tables["dept_emp"]
        .groupBy("emp_no")
        .agg(row_count().alias("total_cambios"))
        .filter(F.col("total_cambios") >= min_rows)
    )
    return (
        tables["dept_emp"]
        .select("emp_no", "dept_no", "from_date")
        .join(counted, "emp_no")
        .join(tables["employees"].select("emp_no", "first_name", "last_name"), "emp_no")
    )


def department_changers(tables: Tables, min_rows: int = 2) -> DataFrame:
    """Employees with several stays, their departments and dates in order.

    Made for cleaned stays, one per employee and department: an employee's arrays
    are then no longer than the list of departments. Use ``department_moves`` on raw
    history.
    """
    stays = F.array_sort(F.collect_list(F.struct("from_date", "dept_no")))
    return (
        department_moves(tables, min_rows)
        .groupBy("emp_no", "first_name", "last_name", "total_cambios")
        .agg(stays.alias("stays"))
        .select(
            "emp_no",
            "first_name",
            "last_name",
            "total_cambios",
            F.col("stays.dept_no").alias("departamentos"),
            F.col("stays.from_date").alias("fechas_cambio"),
        )
        .orderBy(F.desc("total_cambios"), "emp_no")
    )
