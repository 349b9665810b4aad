"""Numbered versions of a table: small manifests, each put in place in one step."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"(\d{12})\.json")


class Versions:
    """The folder ``_versions`` of a table: one JSON manifest a version, numbered from 1.

    A manifest is written under another name and then renamed; a name that is taken makes
    the rename fail, so of two writers of one number one loses. Distributed file systems
    check and rename in one step; a local file system, or an object store without such a
    step, looks for the name just before, and wants one writer at a time.
    Readers see a version whole or not at all.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        folder = self._path("_versions")
        self._store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def numbers(self) -> list[int]:
        folder = self._path("_versions")
        if not self._store.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._store.listStatus(folder)]
        return sorted(int(m[1]) for m in map(_NAME.fullmatch, names) if m)

    def latest(self) -> int:
        """The newest version, 0 where there is none."""
        return max(self.numbers(), default=0)

    def read(self, number: int) -> dict:
        source = self._store.open(self._path(f"_versions/{number:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        return json.loads(text)

    def commit(self, number: int, manifest: dict) -> None:
        """Make ``manifest`` version ``number``; FileExistsError where another writer was first."""
        target = self._path(f"_versions/{number:012d}.json")
        drawn = self._path(f"_versions/.{uuid.uuid4().hex}")
        out = self._store.create(drawn)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._store.exists(target) or not self._store.rename(drawn, target):
            self._store.delete(drawn, False)
            raise FileExistsError(f"version {number} of {self.path}")

    def forget(self, before: int) -> None:
        """Delete the manifests of versions below ``before``."""
        for number in self.numbers():
            if number < before:
                self._store.delete(self._path(f"_versions/{number:012d}.json"), False)

    def folders(self, name: str) -> list[str]:
        """Names of the folders in a folder of the table."""
        folder = self._path(name)
        if not self._store.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._store.listStatus(folder) if s.isDirectory())

    def delete(self, name: str) -> None:
        """Delete a file or folder of the table."""
        self._store.delete(self._path(name), True)
