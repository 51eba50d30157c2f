"""A cleaned zone that is brought up to date where its sources changed.

The rows of a table are dealt into buckets by a hash of the key that every cleaning rule
of the table keeps together (employee, or department). A digest of each bucket's raw rows,
free of their order, is kept in the manifest of the version. A run takes the digests
again, cleans the buckets whose digest differs, and writes those; the others stay in the
folders of the versions that wrote them, and the manifest says where each bucket lies.

The digests are taken before the rows are read, so a source that changes in between has a
digest that is too old, and its bucket is cleaned again by the next run.

Open ends stay open in the zone, so that a run on another day changes no row; a reader
names the day that stands for them. Rules that change do not change digests: pass another
``rules`` text then, and all buckets are cleaned again, as they are when a version would
read from more than ``most_folders`` folders.

Defined results: a bucket without raw rows is not read any more; rows with a NULL key are
one bucket's; repeated rows count as often as they are there; empty tables are versions
without buckets. At most ``buckets`` digests of a table are held by the driver.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tenureframe.functions import row_count
from tenureframe.functions.dates import OPEN_END, DateLike
from tenureframe.plans.cleaning import clean_all_tables, close_open_intervals
from tenureframe.sources.schemas import TABLES
from tenureframe.versions import Versions

Tables = Mapping[str, DataFrame]

BUCKETS = 1024
MOST_FOLDERS = 32
BUCKET = "_bucket"


def bucket_key(table: str) -> str:
    return "dept_no" if table == "departments" else "emp_no"


def _bucket(table: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(bucket_key(table)), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, table: str, buckets: int) -> dict[int, str]:
    """Each bucket's number of rows and the sums of two hashes of its rows."""
    # A hash passes over missing values: whether they are there is hashed as well.
    columns = [c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    sums = [
        F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(20,0)")).cast("decimal(38,0)")
        for salt in (1, 2)
    ]
    found = (
        df.groupBy(_bucket(table, buckets).alias(BUCKET))
        .agg(F.concat_ws(":", row_count().cast("string"), *[s.cast("string") for s in sums]).alias("digest"))
        .collect()
    )
    return {row[BUCKET]: row["digest"] for row in found}


class CleanedZone:
    """The versions at a path, each a set of buckets in folders of this and earlier ones."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        buckets: int = BUCKETS,
        most_folders: int = MOST_FOLDERS,
        rules: str = "",
    ):
        self.spark, self.buckets, self.most_folders = spark, buckets, most_folders
        self.rules = f"{buckets} {rules}"
        self.versions = Versions(spark, path)

    def _places(self, manifest: dict | None, table: str) -> dict[int, str]:
        """The folder of every bucket."""
        placed = (manifest or {}).get("parts", {}).get(table, {}).get("places", {})
        return {bucket: folder for folder, found in placed.items() for bucket in found}

    def update(self, raw: Tables) -> dict[str, list[int]]:
        """Publish the version of these sources; returns the buckets cleaned, per table."""
        last = self.versions.read()
        digests = {name: bucket_digests(raw[name], name, self.buckets) for name in TABLES}
        schemas = {name: raw[name].schema.json() for name in TABLES}
        same = last is not None and (last["rules"], last["schemas"]) == (self.rules, schemas)
        before = last["parts"] if same else {}

        def stays(name: str) -> dict[int, str]:
            known = before.get(name, {}).get("digests", {})
            kept = {b for b, digest in digests[name].items() if known.get(str(b)) == digest}
            return {b: f for b, f in self._places(last, name).items() if b in kept}

        kept = {name: stays(name) for name in TABLES}
        uses = sorted({folder for places in kept.values() for folder in places.values()})
        if len(uses) >= self.most_folders:
            kept, uses = {name: {} for name in TABLES}, []
        todo = {name: sorted(set(digests[name]) - set(kept[name])) for name in TABLES}
        if same and not any(todo.values()) and all(
            set(digests[name]) == set(self._places(last, name)) for name in TABLES
        ):
            return todo
        changed = {
            name: raw[name].filter(_bucket(name, self.buckets).isin(todo[name])) for name in TABLES
        }
        cleaned = clean_all_tables(changed, OPEN_END)

        def writer(name: str):
            def write(folder: str) -> Mapping:
                places: dict[str, list[int]] = {}
                for bucket, place in sorted(kept[name].items()):
                    places.setdefault(place, []).append(bucket)
                if todo[name]:
                    rows = cleaned[name].withColumn(BUCKET, _bucket(name, self.buckets))
                    rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
                    here = folder.removeprefix(f"{self.versions.path}/").removesuffix(f"/{name}")
                    places[here] = todo[name]
                return {
                    "places": places,
                    "digests": digests[name],
                    "schema": cleaned[name].schema.json(),
                }

            return write

        self.versions.publish(
            {name: writer(name) for name in TABLES}, uses=uses, rules=self.rules, schemas=schemas
        )
        return todo

    def read(self, as_of: DateLike | None = None) -> dict[str, DataFrame]:
        """All tables of the last version, ``as_of`` in place of open ends."""
        manifest = self.versions.read()
        if manifest is None:
            raise ValueError(f"nothing was published at {self.versions.path}")
        tables = {}
        for name, part in manifest["parts"].items():
            schema = StructType.fromJson(json.loads(part["schema"]))
            stored = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
            table = None
            for folder, found in part["places"].items():
                files = self.spark.read.schema(stored).parquet(f"{self.versions.path}/{folder}/{name}")
                rows = files.filter(F.col(BUCKET).isin(found)).drop(BUCKET)
                table = rows if table is None else table.unionByName(rows)
            if table is None:
                empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
                table = self.spark.range(0).select(*empty)
            tables[name] = close_open_intervals(table, as_of) if "to_date" in schema.names else table
        return tables
