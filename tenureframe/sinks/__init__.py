"""Distributed writes of tables and reports to any Hadoop file system."""

from tenureframe.sinks.files import (
    period_path,
    publish_csv_report,
    publish_tables,
    report_folder,
    run_stamped_path,
    sample_rows,
    save_tables,
    write_csv_report,
    write_parquet_report,
)
from tenureframe.versions import Versions, published_folder

__all__ = [
    "Versions",
    "period_path",
    "publish_csv_report",
    "publish_tables",
    "published_folder",
    "report_folder",
    "run_stamped_path",
    "sample_rows",
    "save_tables",
    "write_csv_report",
    "write_parquet_report",
]
