"""The same results in DuckDB SQL over the ``orders`` and ``customer`` views."""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
PERIOD = "BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"
MONTH = "BETWEEN DATE '1997-02-01' AND DATE '1997-02-28'"
OPEN = "DATE '9999-01-01'"

# The HR tables as common table expressions.
HR = f"""
linked AS (
  SELECT o_custkey AS emp_no, o_orderkey AS rec_id, substr(o_orderpriority, 1, 1) AS dept_no,
         o_orderstatus AS title, CAST(o_totalprice AS DECIMAL(10,2)) AS salary,
         CAST(o_orderdate AS DATE) AS from_date,
         lead(CAST(o_orderdate AS DATE)) OVER
           (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_date
  FROM orders),
history AS (
  SELECT emp_no, rec_id, dept_no, title, salary, from_date,
         CASE WHEN next_date IS NOT NULL THEN next_date
              WHEN emp_no % 4 = 0 THEN from_date + 90 ELSE {OPEN} END AS to_date
  FROM linked),
hired AS (SELECT emp_no, min(from_date) AS hire_date FROM history GROUP BY emp_no),
employees AS (
  SELECT c_custkey AS emp_no,
         DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS birth_date,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         substr(c_mktsegment, 1, 1) AS gender, hire_date
  FROM customer LEFT JOIN hired ON emp_no = c_custkey),
departments AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS dept_no,
         substr(o_orderpriority, 3) AS dept_name FROM orders),
dept_emp AS (SELECT emp_no, dept_no, from_date, to_date, rec_id FROM history),
dept_manager AS (SELECT * FROM dept_emp WHERE rec_id % 100 = 0),
salaries AS (SELECT emp_no, salary, from_date, to_date, rec_id FROM history),
titles AS (SELECT emp_no, title, from_date, to_date, rec_id FROM history)"""

# The same with faults.
FAULTY = f"""{HR},
raw_employees AS (
  SELECT emp_no, CASE WHEN emp_no % 53 = 0 THEN DATE '1890-01-01' ELSE birth_date END AS birth_date,
         CASE WHEN emp_no % 17 <> 0 THEN first_name END AS first_name, last_name,
         CASE WHEN emp_no % 19 <> 0 THEN gender END AS gender, hire_date
  FROM employees
  UNION ALL
  SELECT emp_no, birth_date, first_name, last_name, gender, hire_date
  FROM employees WHERE emp_no % 10 = 0),
raw_departments AS (
  SELECT dept_no, CASE WHEN dept_no <> '4' THEN '  ' || dept_name || ' ' END AS dept_name
  FROM departments),
raw_dept_emp AS (
  SELECT emp_no, dept_no, from_date,
         CASE WHEN rec_id % 101 = 0 THEN from_date - 1
              WHEN rec_id % 103 = 0 THEN NULL ELSE to_date END AS to_date, rec_id
  FROM dept_emp),
raw_dept_manager AS (
  SELECT emp_no, dept_no, from_date,
         CASE WHEN rec_id % 700 = 0 THEN from_date - 1 ELSE to_date END AS to_date, rec_id
  FROM dept_manager),
raw_salaries AS (
  SELECT emp_no, CASE WHEN rec_id % 107 = 0 THEN CAST(5 AS DECIMAL(10,2))
                      WHEN rec_id % 109 = 0 THEN CAST(2000000 AS DECIMAL(10,2))
                      WHEN rec_id % 113 = 0 THEN NULL ELSE salary END AS salary,
         from_date, to_date, rec_id
  FROM salaries),
raw_titles AS (
  SELECT emp_no, CASE WHEN rec_id % 127 = 0 THEN NULL
                      WHEN title = 'F' THEN '  senior  ENGINEER '
                      WHEN title = 'O' THEN 'staff' ELSE 'Technique Leader' END AS title,
         from_date, to_date, rec_id
  FROM titles)"""


def _closed(column: str = "to_date") -> str:
    return f"CASE WHEN {column} = {OPEN} THEN {AS_OF} ELSE {column} END"


def _clean_stays(table: str, keys: str = "emp_no, dept_no") -> str:
    return f"""
  SELECT emp_no, dept_no, from_date, {_closed()} AS to_date, rec_id FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY from_date DESC, rec_id DESC) AS rn
    FROM {table} WHERE from_date <= to_date) WHERE rn = 1"""


# The faulty tables after cleaning.
CLEAN = f"""{FAULTY},
clean_employees AS (
  SELECT emp_no, birth_date, first_name, last_name,
         CASE WHEN gender IN ('M', 'F') THEN gender ELSE 'U' END AS gender, hire_date
  FROM (
    SELECT *, row_number() OVER (PARTITION BY emp_no
             ORDER BY birth_date DESC NULLS LAST, first_name DESC, last_name DESC, gender DESC,
                      hire_date DESC NULLS LAST) AS rn
    FROM (SELECT emp_no, birth_date, coalesce(first_name, 'UNKNOWN') AS first_name,
                 coalesce(last_name, 'UNKNOWN') AS last_name, coalesce(gender, 'U') AS gender,
                 hire_date FROM raw_employees)) WHERE rn = 1),
clean_departments AS (
  SELECT dept_no, coalesce(trim(dept_name), 'DEPARTMENT_UNKNOWN') AS dept_name
  FROM raw_departments),
clean_dept_emp AS ({_clean_stays("raw_dept_emp")}),
clean_dept_manager AS ({_clean_stays("raw_dept_manager")}),
clean_salaries AS (
  SELECT emp_no, salary, from_date, {_closed()} AS to_date, rec_id FROM (
    SELECT *, row_number() OVER (PARTITION BY emp_no, from_date ORDER BY rec_id DESC) AS rn
    FROM raw_salaries WHERE salary BETWEEN 1000 AND 1000000 AND from_date <= to_date)
  WHERE rn = 1),
clean_titles AS (
  SELECT emp_no, coalesce(title, 'TITLE_UNKNOWN') AS title, from_date, {_closed()} AS to_date,
         rec_id
  FROM (
    SELECT *, row_number() OVER (PARTITION BY emp_no, title, from_date ORDER BY rec_id DESC) AS rn
    FROM (SELECT emp_no, CASE title WHEN '  senior  ENGINEER ' THEN 'Senior  Engineer'
                              WHEN 'staff' THEN 'Staff' ELSE title END AS title,
                 from_date, to_date, rec_id FROM raw_titles WHERE from_date <= to_date))
  WHERE rn = 1)"""


def _hr(select: str) -> str:
    return f"WITH {HR}\n{select}"


def _faulty(select: str) -> str:
    return f"WITH {FAULTY}\n{select}"


def _clean(select: str, extra: str = "") -> str:
    return f"WITH {CLEAN}{extra}\n{select}"


def _text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def _round(value: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


DAYS = _text("from_date", "to_date")
STAY_COLUMNS = f"emp_no, dept_no, {DAYS}, rec_id"
TITLE_COLUMNS = f"emp_no, title, {DAYS}, rec_id"
SALARY_COLUMNS = f"emp_no, CAST(salary AS DOUBLE) AS salary, {DAYS}, rec_id"
EMPLOYEE_COLUMNS = (
    f"emp_no, {_text('birth_date')}, first_name, last_name, gender, {_text('hire_date')}"
)
NAMES = ("employees", "departments", "dept_emp", "dept_manager", "salaries", "titles")
COLUMNS = {
    "employees": ("emp_no", "birth_date", "first_name", "last_name", "gender", "hire_date"),
    "departments": ("dept_no", "dept_name"),
    "dept_emp": ("emp_no", "dept_no", "from_date", "to_date", "rec_id"),
    "dept_manager": ("emp_no", "dept_no", "from_date", "to_date", "rec_id"),
    "salaries": ("emp_no", "salary", "from_date", "to_date", "rec_id"),
    "titles": ("emp_no", "title", "from_date", "to_date", "rec_id"),
}


def _counts(prefix: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows FROM {prefix}{n}" for n in NAMES
    )


def _rule(table: str, rule: str, column: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"count(*) AS violations FROM raw_{table} WHERE {condition}"
    )


NULL_RULES = [_rule(t, "null", c, f"{c} IS NULL") for t in NAMES for c in COLUMNS[t]]
INTERVAL_RULES = [
    _rule(t, "interval", "to_date", "to_date < from_date")
    for t in ("dept_emp", "dept_manager", "salaries", "titles")
]
DOMAIN_RULE = _rule("employees", "domain", "gender", "gender NOT IN ('M', 'F')")
BIRTH_OUTSIDE = "(birth_date < DATE '1900-01-01' OR birth_date > DATE '2023-12-31')"
BIRTH_RULE = _rule("employees", "date_range", "birth_date", BIRTH_OUTSIDE)
SALARY_OUTSIDE = "NOT salary BETWEEN 1000 AND 1000000"
SALARY_RULE = _rule("salaries", "range", "salary", SALARY_OUTSIDE)


def _all(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# Reports

ROTATION = """
SELECT d.dept_no, d.dept_name AS nombre_departamento, g.gone AS cantidad_salidos,
       a.everyone AS cantidad_total,
       """ + _round("100 * CAST(g.gone AS DOUBLE) / a.everyone") + """ AS tasa_rotacion_porcentual
FROM departments d
JOIN (SELECT dept_no, count(DISTINCT emp_no) AS everyone FROM dept_emp GROUP BY dept_no) a
  ON a.dept_no = d.dept_no
JOIN (SELECT dept_no, count(DISTINCT emp_no) AS gone FROM dept_emp
      WHERE to_date <> DATE '9999-01-01' GROUP BY dept_no) g ON g.dept_no = d.dept_no"""

GENDER_COUNTS = """,
per_gender AS (
  SELECT dept_name, gender, count(*) AS n
  FROM dept_emp JOIN employees USING (emp_no) JOIN departments USING (dept_no)
  WHERE to_date = DATE '9999-01-01' GROUP BY dept_name, gender),
shares AS (
  SELECT dept_name, gender, n,
         n * CAST(100 AS DOUBLE) / (SELECT sum(n) FROM per_gender t
                                    WHERE t.dept_name = p.dept_name) AS share
  FROM per_gender p)"""

DISPARITY = f"""WITH {HR}{GENDER_COUNTS},
wide AS (
  SELECT d.dept_name, m.share AS men, f.share AS women, abs(m.share - f.share) AS gap
  FROM (SELECT DISTINCT dept_name FROM shares) d
  LEFT JOIN shares m ON m.dept_name = d.dept_name AND m.gender = 'M'
  LEFT JOIN shares f ON f.dept_name = d.dept_name AND f.gender = 'F')
SELECT dept_name AS departamento, {_round("men")} AS "% Hombres", {_round("women")} AS "% Mujeres",
       {_round("gap")} AS "Diferencia %",
       CASE WHEN men > women THEN 'Masculino' ELSE 'Femenino' END AS "Género predominante",
       rank() OVER (ORDER BY gap DESC NULLS LAST) AS "Ranking Disparidad"
FROM wide"""

RETENTION = f"""WITH {HR},
stays AS (
  SELECT dept_no, emp_no, {_closed()} - from_date AS days FROM dept_emp),
terms AS (
  SELECT m.emp_no, m.dept_no, sum(s.days) / CAST(count(*) AS DOUBLE) / 365 AS years,
         count(DISTINCT s.emp_no) AS staff
  FROM dept_manager m JOIN stays s ON s.dept_no = m.dept_no WHERE s.days > 0
  GROUP BY m.emp_no, m.dept_no),
ranked AS (
  SELECT emp_no AS manager_id, first_name AS manager_name, last_name AS manager_last_name,
         dept_name AS department, years, staff
  FROM terms JOIN employees USING (emp_no) JOIN departments USING (dept_no))
SELECT manager_id, manager_name, manager_last_name, department,
       {_round("years")} AS avg_retention_years, staff AS employee_count,
       rank() OVER (ORDER BY years DESC) AS retention_rank
FROM ranked"""

SENIOR = f"""WITH {HR}
SELECT e.emp_no, e.first_name, e.last_name, CAST(e.hire_date AS VARCHAR) AS hire_date,
       {_round(f"({AS_OF} - e.hire_date) / CAST(365 AS DOUBLE)")} AS seniority,
       t.title AS actual_title, d.dept_name AS actual_dept
FROM employees e
JOIN titles t ON t.emp_no = e.emp_no
 AND (t.emp_no, t.from_date) IN (SELECT (emp_no, max(from_date)) FROM titles GROUP BY emp_no)
JOIN dept_emp s ON s.emp_no = e.emp_no
 AND (s.emp_no, s.from_date) IN (SELECT (emp_no, max(from_date)) FROM dept_emp GROUP BY emp_no)
JOIN departments d ON d.dept_no = s.dept_no
WHERE e.emp_no IN (SELECT emp_no FROM dept_emp WHERE to_date = {OPEN})
ORDER BY seniority DESC, e.emp_no, actual_title, actual_dept
LIMIT 10"""


def _trend(upper: str, prefix: str = "") -> str:
    # avg() in doubles, from an exact sum: NULL pay is in neither part.
    mean = "CAST(sum(salary) AS DOUBLE) / nullif(count(salary), 0)"
    return f"""
SELECT dept_name AS departamento, title, year(s.from_date) AS year_report,
       {_round(mean)} AS avg_salary,
       count(DISTINCT s.emp_no) AS cantidad_empleados
FROM {prefix}salaries s
JOIN {prefix}titles t ON t.emp_no = s.emp_no AND s.from_date >= t.from_date
             AND s.from_date {upper} t.to_date
JOIN {prefix}dept_emp p ON p.emp_no = s.emp_no AND s.from_date >= p.from_date
             AND s.from_date {upper} p.to_date
JOIN {prefix}departments d ON d.dept_no = p.dept_no
GROUP BY dept_name, title, year(s.from_date)"""


TITLE_TENURE = _hr(f"""
SELECT e.emp_no, e.first_name, e.last_name, coalesce(titles_held, 0) AS total_titles,
       CAST(CAST(mean_days / 365 AS DECIMAL(18,6)) AS DOUBLE) AS avg_years_per_position
FROM employees e
LEFT JOIN (SELECT emp_no, count(DISTINCT title) AS titles_held,
                  avg({_closed()} - from_date) AS mean_days
           FROM titles GROUP BY emp_no) h ON h.emp_no = e.emp_no""")


def _latest(table: str, value: str) -> str:
    return f"""(SELECT emp_no, {value} FROM (
    SELECT *, row_number() OVER (PARTITION BY emp_no
           ORDER BY to_date DESC, from_date DESC, rec_id DESC) AS rn FROM {table}) WHERE rn = 1)"""


def _cost(prefix: str = "") -> str:
    return f"""
SELECT dept_name, CAST(sum(p.salary) AS DOUBLE) AS costo_anual
FROM {_latest(prefix + "salaries", "salary")} p
JOIN {prefix}dept_emp s ON s.emp_no = p.emp_no AND s.to_date >= {AS_OF}
JOIN {prefix}departments d ON d.dept_no = s.dept_no
GROUP BY dept_name"""


def _report(prefix: str = "") -> str:
    return f"""
SELECT e.emp_no, e.first_name || ' ' || e.last_name AS full_name,
       d.dept_name AS current_department, t.title AS current_title,
       CAST(p.salary AS DOUBLE) AS current_salary, CAST(e.hire_date AS VARCHAR) AS hire_date,
       {_round(f"({AS_OF} - e.hire_date) / CAST(365 AS DOUBLE)")} AS tenure_years
FROM {prefix}employees e
LEFT JOIN {_latest(prefix + "dept_emp", "dept_no")} s ON s.emp_no = e.emp_no
LEFT JOIN {prefix}departments d ON d.dept_no = s.dept_no
LEFT JOIN {_latest(prefix + "titles", "title")} t ON t.emp_no = e.emp_no
LEFT JOIN {_latest(prefix + "salaries", "salary")} p ON p.emp_no = e.emp_no"""


CHANGERS = _clean("""
SELECT e.emp_no, e.first_name, e.last_name, count(*) AS total_cambios,
       string_agg(s.dept_no, ',' ORDER BY s.from_date, s.dept_no) AS departamentos,
       string_agg(CAST(s.from_date AS VARCHAR), ',' ORDER BY s.from_date, s.dept_no)
         AS fechas_cambio
FROM clean_dept_emp s JOIN clean_employees e ON e.emp_no = s.emp_no
GROUP BY e.emp_no, e.first_name, e.last_name HAVING count(*) >= 2""")

# Change log

MOVES = f"""
SELECT CAST(e.emp_no AS VARCHAR) AS emp_no, concat_ws(' ', first_name, last_name) AS employee_name,
       n.dept_name, CAST(from_date AS VARCHAR) AS change_date, 'department_change' AS change_type,
       o.dept_name AS old_value, n.dept_name AS new_value
FROM (SELECT *, lag(dept_no) OVER (PARTITION BY emp_no ORDER BY from_date, rec_id) AS before
      FROM dept_emp) s
JOIN employees e ON e.emp_no = s.emp_no
JOIN departments n ON n.dept_no = s.dept_no
JOIN departments o ON o.dept_no = s.before
WHERE from_date {PERIOD} AND s.dept_no <> s.before"""

RAISES = f"""
SELECT CAST(e.emp_no AS VARCHAR) AS emp_no, concat_ws(' ', first_name, last_name) AS employee_name,
       'N/A' AS dept_name, CAST(first_day AS VARCHAR) AS change_date,
       'salary_change' AS change_type, CAST(first_pay AS VARCHAR) AS old_value,
       CAST(last_pay AS VARCHAR) AS new_value
FROM (SELECT DISTINCT emp_no, first_value(salary) OVER w AS first_pay,
             last_value(salary) OVER w AS last_pay, first_value(from_date) OVER w AS first_day
      FROM salaries WHERE from_date {PERIOD}
      WINDOW w AS (PARTITION BY emp_no ORDER BY from_date, rec_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) p
JOIN employees e ON e.emp_no = p.emp_no
WHERE first_pay <> last_pay"""

MANAGERS = f"""
SELECT 'N/A' AS emp_no, concat_ws(' ', first_name, last_name) AS employee_name, dept_name,
       CAST(from_date AS VARCHAR) AS change_date, 'manager_change' AS change_type,
       'N/A' AS old_value, 'N/A' AS new_value
FROM dept_manager JOIN employees USING (emp_no) JOIN departments USING (dept_no)
WHERE from_date {PERIOD}"""

RETITLES = f"""
SELECT CAST(emp_no AS VARCHAR) AS emp_no, concat_ws(' ', first_name, last_name) AS employee_name,
       'N/A' AS dept_name, CAST(from_date AS VARCHAR) AS change_date,
       'title_change' AS change_type, 'N/A' AS old_value, title AS new_value
FROM titles JOIN employees USING (emp_no)
WHERE from_date {PERIOD}"""

LOG = _all([MOVES, RAISES, MANAGERS, RETITLES])


def _newest(table: str, kind: str, value: str) -> str:
    return f"""
SELECT emp_no, '{kind}_change' AS change_type, {value} AS new_value, from_date FROM (
  SELECT *, row_number() OVER (PARTITION BY emp_no ORDER BY from_date DESC, rec_id DESC) AS rn
  FROM {table} WHERE from_date {PERIOD}) LEFT JOIN departments USING (dept_no) WHERE rn = 1"""


LATEST = f"""
SELECT emp_no, first_name || ' ' || last_name AS full_name, change_type, new_value,
       CAST(from_date AS VARCHAR) AS change_date
FROM ({_all([
    _newest("dept_emp", "department", "dept_name"),
    _newest("(SELECT *, '' AS dept_no FROM salaries)", "salary", "CAST(salary AS VARCHAR)"),
    _newest("(SELECT *, '' AS dept_no FROM titles)", "title", "title"),
])}) JOIN employees USING (emp_no)"""


def _lagged(prefix: str, rows: str, kept: str) -> str:
    """Previous and new values; ``rows`` limits history, ``kept`` limits the result."""

    def lag(table: str, value: str) -> str:
        return f"""(SELECT emp_no, from_date, {value} AS value, lag({value}) OVER
              (PARTITION BY emp_no ORDER BY from_date, rec_id) AS before
        FROM {prefix}{table} WHERE {rows})"""

    names = f"(SELECT dept_no AS value, dept_name FROM {prefix}departments)"
    return f"""
SELECT emp_no, first_name || ' ' || last_name AS full_name, change_type, old_value, new_value,
       CAST(from_date AS VARCHAR) AS change_date
FROM (
  SELECT emp_no, from_date, 'department_change' AS change_type, o.dept_name AS old_value,
         n.dept_name AS new_value
  FROM {lag("dept_emp", "dept_no")} c JOIN {names} n ON n.value = c.value
  LEFT JOIN {names} o ON o.value = c.before WHERE before IS NOT NULL
  UNION ALL
  SELECT emp_no, from_date, 'salary_change', CAST(before AS VARCHAR), CAST(value AS VARCHAR)
  FROM {lag("salaries", "salary")} WHERE before IS NOT NULL
  UNION ALL
  SELECT emp_no, from_date, 'title_change', before, value
  FROM {lag("titles", "title")} WHERE before IS NOT NULL)
JOIN {prefix}employees USING (emp_no)
WHERE from_date {kept}"""


def _interval(upper: str) -> str:
    return _hr(f"""
SELECT s.emp_no, CAST(salary AS DOUBLE) AS salary, CAST(s.from_date AS VARCHAR) AS pay_date, title,
       CAST(t.from_date AS VARCHAR) AS from_date, CAST(t.to_date AS VARCHAR) AS to_date
FROM salaries s JOIN titles t ON t.emp_no = s.emp_no AND s.from_date >= t.from_date
                             AND s.from_date {upper} t.to_date""")


ORACLE: dict[str, str] = {
    "scan_all_tables": _hr(_counts()),
    "scan_parquet": _hr(f"SELECT {SALARY_COLUMNS} FROM salaries"),
    "period_scan": _hr(f"SELECT {TITLE_COLUMNS} FROM titles WHERE titles.from_date {MONTH}"),
    "sink_parquet_roundtrip": _clean(f"SELECT {SALARY_COLUMNS} FROM clean_salaries"),
    "sink_parquet_report": _hr(_cost()),
    "sink_csv_roundtrip": _hr(LOG),
    "sink_run_csv": _hr(LATEST),
    "sink_period_csv": _hr(_lagged("", "true", MONTH)),
    "sample_rows": _hr(f"SELECT {EMPLOYEE_COLUMNS} FROM employees ORDER BY emp_no LIMIT 3"),
    "clean_employees": _clean(f"SELECT {EMPLOYEE_COLUMNS} FROM clean_employees"),
    "clean_departments": _clean("SELECT dept_no, dept_name FROM clean_departments"),
    "clean_dept_emp": _clean(f"SELECT {STAY_COLUMNS} FROM clean_dept_emp"),
    "clean_dept_emp_all_stays": _faulty(
        f"SELECT {STAY_COLUMNS} FROM "
        f"({_clean_stays('raw_dept_emp', 'emp_no, dept_no, from_date')})"
    ),
    "clean_dept_manager": _clean(f"SELECT {STAY_COLUMNS} FROM clean_dept_manager"),
    "clean_salaries": _clean(f"SELECT {SALARY_COLUMNS} FROM clean_salaries"),
    "clean_salaries_where_changed": _clean(f"SELECT {SALARY_COLUMNS} FROM clean_salaries"),
    "clean_titles": _clean(f"SELECT {TITLE_COLUMNS} FROM clean_titles"),
    "clean_all_tables": _clean(_counts("clean_")),
    "close_open_intervals": _hr(
        f"SELECT emp_no, title, {_text('from_date')}, CAST({_closed()} AS VARCHAR) AS to_date, "
        "rec_id FROM titles"
    ),
    "dedupe_by_key": _hr(
        f"SELECT {STAY_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY emp_no, dept_no "
        "ORDER BY from_date DESC, rec_id DESC) AS rn FROM dept_emp) WHERE rn = 1"
    ),
    "dq_null_report": _faulty(f"SELECT table_name, column_name, violations FROM ({_all(NULL_RULES)})"),
    "dq_domain_check": _faulty(
        "SELECT gender AS value, count(*) AS violations FROM raw_employees "
        "WHERE gender NOT IN ('M', 'F') GROUP BY gender"
    ),
    "dq_range_check": _faulty(SALARY_RULE),
    "dq_range_profile": _faulty(
        'SELECT count(*) AS "count", '
        + _round("avg(CAST(salary AS DOUBLE))")
        + ' AS "mean", '
        + _round("stddev_samp(CAST(salary AS DOUBLE))")
        + ' AS "stddev", CAST(min(salary) AS DOUBLE) AS "min", '
        + ", ".join(
            f"CAST(quantile_disc(salary, {p}) AS DOUBLE) AS q{int(p * 100)}"
            for p in (0.25, 0.5, 0.75)
        )
        + f', CAST(max(salary) AS DOUBLE) AS "max" FROM raw_salaries WHERE {SALARY_OUTSIDE}'
    ),
    "dq_date_range_check": _faulty(BIRTH_RULE),
    "dq_date_range_sample": _faulty(
        f"SELECT emp_no, CAST(birth_date AS VARCHAR) AS birth_date FROM raw_employees "
        f"WHERE {BIRTH_OUTSIDE} ORDER BY raw_employees.birth_date, emp_no LIMIT 5"
    ),
    "dq_interval_check": _faulty(
        f"SELECT *, violations = 0 AS passed FROM ({_all(INTERVAL_RULES)})"
    ),
    "dq_interval_sample": _faulty(
        f"SELECT emp_no, dept_no, {_text('from_date', 'to_date')}, rec_id FROM raw_dept_emp "
        "WHERE to_date < from_date ORDER BY raw_dept_emp.from_date, rec_id LIMIT 5"
    ),
    "dq_suite": _faulty(
        _all([*NULL_RULES, *INTERVAL_RULES, DOMAIN_RULE, BIRTH_RULE, SALARY_RULE])
    ),
    "dq_suite_while_saving": _faulty(
        _all([*NULL_RULES, *INTERVAL_RULES, DOMAIN_RULE, BIRTH_RULE, SALARY_RULE])
    ),
    "dept_rotation": _hr(ROTATION),
    "gender_disparity": DISPARITY,
    "manager_retention_rank": RETENTION,
    "most_senior": SENIOR,
    "salary_trend": _hr(_trend("<=")),
    "salary_trend_left": _hr(_trend("<")),
    "salary_trend_faulty": _faulty(_trend("<=", "raw_")),
    "title_tenure": TITLE_TENURE,
    "annual_cost": _hr(_cost()),
    "annual_cost_cleaned": _clean(_cost("clean_")),
    "annual_cost_bucketed": _clean(_cost("clean_")),
    "employee_report": _hr(_report()),
    "employee_report_cleaned": _clean(_report("clean_")),
    "employee_report_bucketed": _clean(_report("clean_")),
    "dept_changers": CHANGERS,
    "dept_moves": _hr("""
SELECT s.emp_no, s.dept_no, CAST(s.from_date AS VARCHAR) AS from_date, n AS total_cambios,
       first_name, last_name
FROM dept_emp s JOIN employees e ON e.emp_no = s.emp_no
JOIN (SELECT emp_no, count(*) AS n FROM dept_emp GROUP BY emp_no HAVING count(*) >= 2) c
  ON c.emp_no = s.emp_no"""),
    "change_log_dept": _hr(MOVES),
    "change_log_salary": _hr(RAISES),
    "change_log_manager": _hr(MANAGERS),
    "change_log_title": _hr(RETITLES),
    "change_log": _hr(LOG),
    "change_log_summary": _hr(
        f'SELECT change_type, count(*) AS "count" FROM ({LOG}) GROUP BY change_type'
    ),
    "latest_change_report": _hr(LATEST),
    "lag_change_report": _clean(_lagged("clean_", "true", PERIOD)),
    "monthly_change_report_period": _hr(_lagged("", f"from_date {MONTH}", MONTH)),
    "monthly_change_report": _hr(_lagged("", "true", MONTH)),
    "monthly_change_report_from_state": _hr(_lagged("", "true", MONTH)),
    "previous_month_range": _hr(
        f"SELECT emp_no, {_text('hire_date')}, "
        "CAST(CAST(date_trunc('month', employees.hire_date) - INTERVAL 1 MONTH AS DATE) AS VARCHAR)"
        " AS first_day, "
        "CAST(CAST(date_trunc('month', employees.hire_date) AS DATE) - 1 AS VARCHAR) AS last_day "
        "FROM employees"
    ),
    "latest_per_key": _hr(
        f"SELECT {SALARY_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY emp_no "
        "ORDER BY from_date DESC, rec_id DESC) AS rn FROM salaries) WHERE rn <= 2"
    ),
    "active_at": _hr(
        f"SELECT {STAY_COLUMNS} FROM dept_emp "
        "WHERE DATE '1998-06-30' BETWEEN dept_emp.from_date AND dept_emp.to_date"
    ),
    "interval_join": _interval("<="),
    "interval_join_left": _interval("<"),
    "interval_join_distinct": _hr("""
SELECT s.emp_no, CAST(s.from_date AS VARCHAR) AS pay_date, title,
       CAST(t.from_date AS VARCHAR) AS from_date, CAST(t.to_date AS VARCHAR) AS to_date,
       count(*) AS n
FROM salaries s JOIN titles t ON t.emp_no = s.emp_no AND s.from_date >= t.from_date
                             AND s.from_date <= t.to_date
GROUP BY s.emp_no, s.from_date, title, t.from_date, t.to_date"""),
    "detect_changes": _hr(
        f"SELECT {TITLE_COLUMNS}, prev_title FROM (SELECT *, lag(title) OVER "
        "(PARTITION BY emp_no ORDER BY from_date, rec_id) AS prev_title FROM titles) "
        "WHERE title <> prev_title"
    ),
    "first_last_in_period": _hr(
        f"SELECT emp_no, CAST(arg_min(salary, k) AS DOUBLE) AS old_salary, "
        "CAST(arg_max(salary, k) AS DOUBLE) AS new_salary, "
        "CAST(min(from_date) AS VARCHAR) AS change_date "
        "FROM (SELECT *, (from_date - DATE '1970-01-01') * 1000000000 + rec_id AS k "
        f"FROM salaries WHERE from_date {PERIOD}) GROUP BY emp_no "
        "HAVING arg_min(salary, k) <> arg_max(salary, k)"
    ),
    "share_within_group": f"WITH {HR}{GENDER_COUNTS}\n"
    f"SELECT dept_name, gender, n AS rows, {_round('share')} AS share FROM shares",
    "pivot_values": f"WITH {HR}{GENDER_COUNTS}\n"
    "SELECT dept_name, max(n) FILTER (gender = 'M') AS men, max(n) FILTER (gender = 'F') AS women "
    "FROM per_gender GROUP BY dept_name",
    "interval_years": _hr(
        "SELECT emp_no, rec_id, "
        + _round(f"({_closed()} - from_date) / CAST(365 AS DOUBLE)")
        + " AS years FROM dept_emp"
    ),
    "max_date_rows": _hr(
        f"SELECT {TITLE_COLUMNS} FROM titles WHERE (emp_no, titles.from_date) IN "
        "(SELECT (emp_no, max(from_date)) FROM titles GROUP BY emp_no)"
    ),
}
