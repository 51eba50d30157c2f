"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def spark_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the reports count on.

    Master, memory and the number of shuffle partitions are left to
    spark-submit; adaptive execution merges small shuffle partitions and splits
    skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}
_given: dict[str, list[str]] = {}


def _local_folder(application: str) -> str:
    """A temporary folder of a local session, removed when Python ends."""
    if application not in _local_folders:
        folder = tempfile.mkdtemp(prefix="tenureframe-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[application] = folder
    return _local_folders[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share.

    The folder is ``spark.checkpoint.dir``. Only a local session that has none
    gets one of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder(context.applicationId)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _given.setdefault(context.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Remove what this session wrote under paths from ``scratch_path``."""
    context = spark.sparkContext
    for path in _given.pop(context.applicationId, []):
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
