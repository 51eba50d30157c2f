"""The last row of every employee and kind at each month's end, rolled forward by month.

A month's report needs, besides the month's rows, the value that each employee had
before. The state table holds just that: one row per employee and kind, whatever the
length of the history. The state of a month's end is the former state with the rows of
the month laid over it, so a month reads the former state and its own rows. States are
published as versions that name their month's end; a month that is run again starts from
the same state and gives the same report and state.

A state knows history as it was when its months were run. After corrections to earlier
rows, run ``rebuild``, which reads all history up to the month's end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureframe.functions import as_date
from tenureframe.operators import latest_per_key
from tenureframe.plans.change_reports import values_by_kind
from tenureframe.sources.schemas import history_order
from tenureframe.sources.tables import period_rows
from tenureframe.versions import Versions

Tables = Mapping[str, DataFrame]

STATE_FOLDER, PART = "state", "last_rows"
KEYS = ["emp_no", "change_type"]


def _last(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, KEYS, history_order(rows.columns, "value"))


def state_from_scratch(tables: Tables, end: dt.date) -> DataFrame:
    """The last row per employee and kind up to and with ``end``, from all history."""
    history = values_by_kind(tables)
    return _last(history.filter((F.col("from_date") <= as_date(end)) | F.col("from_date").isNull()))


def roll_forward(state: DataFrame, tables: Tables, start: dt.date, end: dt.date) -> DataFrame:
    """The state at ``end`` from that of the day before ``start`` and the rows between."""
    return _last(state.unionByName(period_rows(values_by_kind(tables), start, end)))


class MonthStates:
    """The published states below ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.versions = Versions(spark, f"{base.rstrip('/')}/{STATE_FOLDER}")

    def ends(self) -> dict[dt.date, int]:
        """The last version for each month's end."""
        found = {}
        for number in self.versions.numbers():
            end = self.versions.read(number)["parts"][PART]["end"]
            found[dt.date.fromisoformat(end)] = number
        return found

    def read(self, end: dt.date, schema) -> DataFrame | None:
        number = self.ends().get(end)
        if number is None:
            return None
        return self.spark.read.schema(schema).parquet(f"{self.versions.folder(number)}/{PART}")

    def publish(self, state: DataFrame, end: dt.date) -> None:
        def write(folder: str) -> Mapping:
            state.write.parquet(folder)
            return {"end": end.isoformat()}

        self.versions.publish({PART: write})

    def rebuild(self, tables: Tables, end: dt.date) -> DataFrame:
        """Publish the state at ``end`` from all history."""
        state = state_from_scratch(tables, end)
        self.publish(state, end)
        return self.read(end, state.schema)

    def before(self, tables: Tables, start: dt.date) -> DataFrame:
        """The state of the day before ``start``: as published, or rolled forward from the
        last one before it, or from scratch where there is none."""
        wanted = start - dt.timedelta(days=1)
        schema = values_by_kind(tables).schema
        earlier = [end for end in self.ends() if end <= wanted]
        if not earlier:
            return self.rebuild(tables, wanted)
        last = max(earlier)
        state = self.read(last, schema)
        if last < wanted:
            state = roll_forward(state, tables, last + dt.timedelta(days=1), wanted)
            self.publish(state, wanted)
            state = self.read(wanted, schema)
        return state
