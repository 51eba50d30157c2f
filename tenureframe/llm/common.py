"""What the corpus operators share: inputs, staging, and Arrow batch helpers."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureframe.session import scratch_path


# Bytes of an Arrow batch: texts are long, and every worker holds some batches.
ARROW_BATCH_BYTES = 4 * 2**20


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and keep
    their batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back.

    Later steps then start from a scan: a lost executor costs a re-read, and what
    is used twice is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes within drop their shuffle files when they end, instead of when the driver
    happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    former = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, former)


def bucket_count(rows: int, per_bucket: int) -> int:
    return max(1, math.ceil(rows / per_bucket))


def per_batch(
    convert: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from a function on one batch; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield convert(batch)

    return run


# Names above this length are not remembered from one batch to the next.
LONG_NAME = 64


def forget(memory: dict, remember: int) -> None:
    """Halve an overfull memory. The oldest entries stay: what is common comes early."""
    if len(memory) > remember:
        for name in list(memory)[remember // 2 :]:
            del memory[name]


def forget_long(memory: dict, names: Iterable[str]) -> None:
    """Drop long names, so that a memory is bounded in bytes as well."""
    for name in names:
        if len(name) > LONG_NAME:
            memory.pop(name, None)


def portions(texts: list[str], characters: int = 4_000_000) -> Iterator[list[str]]:
    """The texts of an Arrow batch in runs of about so many characters."""
    start, size = 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= characters:
            yield texts[start:i]
            start, size = i, 0
    if start < len(texts):
        yield texts[start:]
