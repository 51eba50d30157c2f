"""Versions of what a path holds: a write becomes visible by one rename.

A run writes all its parts (tables, or the files of a report) into a folder of its own,
and then a manifest beside the earlier ones. The manifest is written under another name
and renamed to the next number; only then do readers find it. A run that fails before
leaves the former version as it is, complete, and its own files unseen. A reader that
has opened a version keeps reading it while the next one is published.

On file systems without an atomic rename of one file the manifest needs one that has it,
or a committer of its own. Two runs that publish at once get different numbers, or the
later one fails: a number is never given twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

# Folders that Spark passes over when the path itself is read.
VERSIONS, MANIFESTS = "_versions", "_manifests"

Writer = Callable[[str], Mapping | None]


class Versions:
    """The published versions at a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _manifest(self, number: int):
        return self._at(f"{self.path}/{MANIFESTS}/{number:010d}.json")

    def numbers(self) -> list[int]:
        """The published versions, oldest first."""
        folder = self._at(f"{self.path}/{MANIFESTS}")
        if not self._files.exists(folder):
            return []
        names = [entry.getPath().getName() for entry in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[:1].isdigit())

    def read(self, number: int | None = None) -> dict | None:
        """The manifest of a version, by default of the last one; None without any."""
        numbers = self.numbers()
        if number is None:
            number = numbers[-1] if numbers else None
        if number not in numbers:
            return None
        stream = self._files.open(self._manifest(number))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def folder(self, number: int | None = None) -> str | None:
        """Where a version lies, by default the last one; None without any."""
        manifest = self.read(number)
        return manifest and f"{self.path}/{manifest['folder']}"

    def publish(self, writers: Mapping[str, Writer], **more) -> dict:
        """Let every writer write its part, then make all parts visible at once.

        What a writer returns is kept in the manifest under the name of its part, ``more``
        beside the parts. ``uses`` in it lists folders of earlier versions that this one
        reads from.
        """
        folder = f"{VERSIONS}/{uuid.uuid4().hex}"
        parts = {name: write(f"{self.path}/{folder}/{name}") or {} for name, write in writers.items()}
        return self._commit({"folder": folder, "parts": parts} | more)

    def _commit(self, manifest: dict) -> dict:
        numbers = self.numbers()
        manifest = {"number": numbers[-1] + 1 if numbers else 1} | manifest
        unseen = self._at(f"{self.path}/{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self._files.create(unseen, False)
        try:
            stream.write(bytearray(json.dumps(manifest), "utf-8"))
        finally:
            stream.close()
        seen = self._manifest(manifest["number"])
        if self._files.exists(seen) or not self._files.rename(unseen, seen):
            self._files.delete(unseen, False)
            raise RuntimeError(f"version {manifest['number']} of {self.path} was published by another run")
        return manifest

    def remove_old(self, keep: int = 2) -> list[int]:
        """Remove all but the last ``keep`` versions; the manifest goes before the files, so
        no reader finds a version in part. Folders that a version left uses stay until that
        one goes. Files of failed runs are not touched."""
        if keep < 1:
            raise ValueError("the last version stays")

        def folders(number: int) -> set[str]:
            manifest = self.read(number)
            return {manifest["folder"], *manifest.get("uses", ())}

        numbers = self.numbers()
        old = numbers[:-keep]
        used = set().union(*map(folders, numbers[-keep:]))
        for number in old:
            unused = folders(number) - used
            self._files.delete(self._manifest(number), False)
            for folder in unused:
                self._files.delete(self._at(f"{self.path}/{folder}"), True)
        return old


def published_folder(spark: SparkSession, path: str) -> str:
    """The folder of the last published version, or the path itself if it has none."""
    return Versions(spark, path).folder() or path.rstrip("/")
