"""Run a query and its SQL on the same files and compare all rows."""

from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: [(value is not None, str(value)) for value in row],
    )


def spark_rows(df):
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), _sorted_rows(names, result.fetchall())
