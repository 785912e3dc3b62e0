"""Surrogate keys that outlast loads: a stored map from members to keys, which only grows.

A load looks up the members it knows, gives keys above the largest so far to the new ones, and
commits these as one more folder of the map. Members that are gone keep their keys. Copies of a
member have a key each: a run of keys per load that brought more of them than were known.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.keys import first_keys, row_digest, unrolled
from tallyhouse.sources.commits import CommitLog, ConflictingWrite
from tallyhouse.sources.layers import cut_lineage

_RUNS = "_d string, _start long, _held long, _before long"
_FOLDERS = 16  # of a map before they are folded into one
_ATTEMPTS = 5


class KeyMap:
    """The keys of one dimension, below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._log = CommitLog(spark, f"{self._path}/_log")

    def _state(self) -> tuple[int, list[str], int]:
        base = self._log.last()
        entry = self._log.read(base) if base >= 0 else {"folders": [], "keys": 0}
        return base, entry["folders"], entry["keys"]

    def _runs(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self._spark.createDataFrame([], _RUNS)
        return self._spark.read.schema(_RUNS).parquet(*[f"{self._path}/{f}" for f in folders])

    def size(self) -> int:
        """Keys given so far."""
        return self._state()[2]

    def keyed(self, members: DataFrame, name: str, columns: list[str] | None = None, unique: bool = True) -> DataFrame:
        """The members with their keys in ``name``; new ones follow the largest key, in the order of a
        digest of ``columns`` (default: all). ``unique=False`` allows whole-row copies.

        A load that fails or is repeated gives no key twice: keys count once their folder is
        committed. Where another load commits first, the members are looked up again.
        """
        if columns and not unique:
            raise ValueError("copies are copies of whole rows")
        columns = columns or members.columns
        counted = members.groupBy(*members.columns).agg(F.count(F.lit(1)).alias("_n"))
        if unique:
            twice = F.raise_error(F.concat(F.lit("member given twice: "), F.to_json(F.struct(*columns)))).cast("long")
            counted = counted.withColumn("_n", F.when(F.col("_n") > 1, twice).otherwise(F.col("_n")))
        counted = cut_lineage(counted.withColumn("_d", row_digest(columns)), "members")
        for _ in range(_ATTEMPTS):
            base, folders, given = self._state()
            try:
                folders = self._extend(counted, columns, base, folders, given)
                break
            except ConflictingWrite:
                continue
        else:
            raise ConflictingWrite(f"{self._path}: other loads kept committing")
        runs = counted.join(self._runs(folders), "_d")
        taken = F.least(F.col("_held"), F.col("_n") - F.col("_before"))
        runs = runs.select(F.col("_start").alias("_first"), taken.alias("_n"), *members.columns).where("_n > 0")
        if unique:
            return runs.select(F.col("_first").alias(name), *members.columns)
        return unrolled(runs, name, members.columns)

    def _extend(self, counted: DataFrame, columns: list[str], base: int, folders: list[str], given: int) -> list[str]:
        known = self._runs(folders).groupBy("_d").agg(F.sum("_held").alias("_known"))
        held = F.coalesce("_known", F.lit(0).cast("long"))
        fresh = counted.join(known, "_d", "left").withColumn("_more", F.col("_n") - held).withColumn("_before", held).where("_more > 0")
        # first_keys makes its own digest column from the same columns.
        placed = first_keys(fresh.select(*columns, "_more", "_before"), columns, "_more")
        runs = placed.select(row_digest(columns).alias("_d"), (F.col("_first") + given).alias("_start"), F.col("_more").alias("_held"), "_before")
        folder = f"keys-{uuid.uuid4().hex}"
        runs.write.parquet(f"{self._path}/{folder}")
        added = self._runs([folder]).agg(F.sum("_held")).first()[0] or 0
        if not added:
            return folders
        folders = [*folders, folder]
        if len(folders) > _FOLDERS:
            one = f"keys-{uuid.uuid4().hex}"
            self._runs(folders).write.parquet(f"{self._path}/{one}")
            folders = [one]
        self._log.commit(base, {"folders": folders, "keys": given + added})
        return folders
