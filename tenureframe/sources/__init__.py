"""Declared schemas and table readers."""

from tenureframe.sources.schemas import (
    ENTITY_TABLES,
    HISTORY_TABLES,
    RECORD_ID,
    TABLES,
    table_schema,
)
from tenureframe.sources.tables import (
    JdbcConnection,
    JdbcSplit,
    jdbc_split,
    period_rows,
    read_jdbc_table,
    read_jdbc_tables,
    read_parquet_tables,
)

__all__ = [
    "ENTITY_TABLES",
    "HISTORY_TABLES",
    "RECORD_ID",
    "TABLES",
    "JdbcConnection",
    "JdbcSplit",
    "jdbc_split",
    "period_rows",
    "read_jdbc_table",
    "read_jdbc_tables",
    "read_parquet_tables",
    "table_schema",
]
