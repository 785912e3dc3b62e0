"""A commit log beside a table's files: numbered manifests, each written by one writer only.

A manifest is a small JSON file. It is written under another name and then renamed to its number,
which fails where that number exists, so of two writers that start from one manifest the second is
refused, and no reader ever sees a manifest that is not complete. Files of a table are never
changed, only named by a later manifest or not.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DIGITS = 12


class ConflictingWrite(RuntimeError):
    """Another writer has committed since the manifest that this one started from."""


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._context = self._hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._hadoop.Path(path)

    def _file(self, number: int):
        return self._at(f"{self.path}/{number:0{_DIGITS}d}")

    def numbers(self) -> list[int]:
        """Manifests that are there, in order."""
        folder = self._at(self.path)
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n) for n in names if n.isdigit() and len(n) == _DIGITS)

    def last(self) -> int:
        """The last manifest, -1 where there is none."""
        return max(self.numbers(), default=-1)

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._file(number))
        try:
            return json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: int, entry: dict) -> int:
        """Writes the manifest that follows ``base`` (-1: the first); refuses where it exists."""
        waiting, target = self._at(f"{self.path}/.{uuid.uuid4().hex}"), self._file(base + 1)
        out = self._fs.create(waiting)
        out.write(json.dumps(entry, sort_keys=True).encode())
        out.close()
        plain = self._spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            self._context.rename(self._fs.makeQualified(waiting), self._fs.makeQualified(target), plain)
        except Py4JJavaError as e:
            self._fs.delete(waiting, False)
            if self._fs.exists(target):
                raise ConflictingWrite(f"{self.path}: {base + 1} was committed by another writer") from e
            raise
        return base + 1

    def forget_before(self, number: int) -> None:
        """Deletes older manifests."""
        for old in self.numbers():
            if old < number:
                self._fs.delete(self._file(old), False)
