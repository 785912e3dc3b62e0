"""A stored table that batches are merged into by key, bucket by bucket.

Rows are kept in buckets by a hash of the key. A merge reads the buckets that the batch touches,
combines their rows with the batch's, and writes these buckets anew; a manifest then names the new
folders for them and the old ones for all others. Readers keep the version they began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.commits import CommitLog, ConflictingWrite
from tallyhouse.sources.layers import cut_lineage

BUCKETS = 64
_KEPT = 2  # versions whose folders stay: the last one, and the one that running queries may read
_ATTEMPTS = 5


class MergedTable:
    """A table of rows by ``key`` below ``path``. ``combine`` makes one row per key of any rows with the table's
    columns; it must not mind the order of rows, nor rows that come twice."""

    def __init__(self, spark: SparkSession, path: str, key: str, combine: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS):
        self._spark, self._path, self._key, self._combine = spark, path.rstrip("/"), key, combine
        self._log = CommitLog(spark, f"{self._path}/_log")
        base = self._log.last()
        self.buckets = self._log.read(base)["buckets"] if base >= 0 else buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self._key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The last merge, -1 before the first."""
        return self._log.last()

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        version = self._log.last() if version is None else version
        return {int(b): f for b, f in self._log.read(version)["folders"].items()} if version >= 0 else {}

    def _rows(self, folders: list[str], schema: str) -> DataFrame:
        if not folders:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*[f"{self._path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of a version, by default the last."""
        version = self._log.last() if version is None else version
        if version < 0:
            raise ValueError(f"{self._path} has no rows yet")
        entry = self._log.read(version)
        return self._rows(sorted(entry["folders"].values()), entry["schema"])

    def merge(self, batch: DataFrame) -> int:
        """Merges rows in and returns the version that has them. A merge that is repeated changes
        nothing; where another one commits first, the touched buckets are read and merged again."""
        marked = cut_lineage(self._combine(batch).withColumn("_bucket", self._bucket()), "batch")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields if f.name != "_bucket")
        touched = sorted(r[0] for r in marked.select("_bucket").distinct().collect())  # buckets, not keys
        for _ in range(_ATTEMPTS):
            base = self._log.last()
            if not touched and base >= 0:
                return base
            folders = self.folders(base)
            old = self._rows([folders[b] for b in touched if b in folders], schema).withColumn("_bucket", self._bucket())
            merged = self._combine(old.unionByName(marked).drop("_bucket")).withColumn("_bucket", self._bucket())
            version = f"v-{uuid.uuid4().hex}"
            # Rebalanced by bucket: few files each, and a large bucket is written by several tasks.
            merged.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self._path}/{version}")
            folders |= {b: f"{version}/_bucket={b}" for b in touched}
            try:
                done = self._log.commit(base, {"buckets": self.buckets, "schema": schema, "folders": folders})
            except ConflictingWrite:
                continue
            return done
        raise ConflictingWrite(f"{self._path}: other merges kept committing")

    def clean_up(self) -> list[str]:
        """Deletes versions' folders that the last manifests do not name, and older manifests; returns the
        folders. Not to be run beside a merge, whose folder no manifest names yet."""
        numbers = self._log.numbers()[-_KEPT:]
        named = {f.split("/")[0] for n in numbers for f in self.folders(n).values()}
        fs, at = self._log._fs, self._log._at
        gone = sorted(
            name
            for name in (s.getPath().getName() for s in fs.listStatus(at(self._path)))
            if name.startswith("v-") and name not in named
        )
        for name in gone:
            fs.delete(at(f"{self._path}/{name}"), True)
        if numbers:
            self._log.forget_before(numbers[0])
        return gone
