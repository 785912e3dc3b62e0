"""The three layers as databases, and loading tables into them.

A published table is a folder per version below ``root``, and a commit log that names the current
one. A load writes a new version, has it checked, commits it, and only then points the catalog at
it, so a load that fails leaves the old rows. Of two loads that began with the same version the second
to commit is refused. The catalog is rebuilt from the logs where a session does not know a table yet,
and readers go by the log while the catalog is between two versions.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.keys import insert_identity
from tallyhouse.session import work_root
from tallyhouse.sources.commits import CommitLog
from tallyhouse.sources.schemas import LAYERS, STAGING

_LOG = "_log"
_KEPT_VERSIONS = 2  # the current one, and the one that running queries may still read
_CODEC = "zstd"  # tables stay on disk while others are built from them
_ABANDONED = 24 * 3600  # seconds after which a version that was never committed is that of a dead load


class LoadRefused(ValueError):
    """A new version broke the table's contract; the old one stays."""


def database(layer: str, prefix: str = "") -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{prefix}{layer}"


class _Folder:
    """A folder on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())
        self._spark = spark

    def below(self, name: str) -> _Folder:
        return _Folder(self._spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at)) if self.exists() else []

    def delete(self) -> None:
        self._fs.delete(self._at, True)


def layers_root(spark: SparkSession, root: str | None = None) -> str:
    """Where the layers live: outlasts an application, unlike the work folder."""
    return (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def ensure_layers(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    """Create the layers that do not exist yet, and list the tables that an earlier application
    has published below ``root``."""
    for layer in LAYERS:
        name = database(layer, prefix)
        folder = _Folder(spark, f"{layers_root(spark, root)}/{name}")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder.path}'")
        for table in folder.names():
            versions = _published(folder.below(table))
            if versions and not has_table(spark, layer, table, prefix):
                _create(spark, f"`{name}`.`{table}`", versions[-1].path)


def reset_layers(spark: SparkSession, prefix: str = "", *, confirm: bool = False, root: str | None = None) -> None:
    """Drop the layers with their tables and create them empty."""
    if not confirm:
        raise ValueError("reset_layers drops every table; pass confirm=True")
    for layer in LAYERS:
        name = database(layer, prefix)
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
        _Folder(spark, f"{layers_root(spark, root)}/{name}").delete()
    ensure_layers(spark, prefix, root)


def _log_of(spark: SparkSession, table: _Folder) -> CommitLog:
    return CommitLog(spark, f"{table.path}/{_LOG}")


def _published(table: _Folder) -> list[_Folder]:
    """Committed versions that are there, oldest first."""
    log = _log_of(table._spark, table)
    return [v for v in (table.below(log.read(n)["version"]) for n in log.numbers()) if v.exists()]


def _clean_up(table: _Folder, log: CommitLog) -> None:
    """Deletes all but the last versions, and what loads that died have left."""
    kept = log.numbers()[-_KEPT_VERSIONS:]
    named = {log.read(n)["version"] for n in log.numbers()}
    current = {log.read(n)["version"] for n in kept}
    for name in table.names():
        if not name.startswith("v-") or name in current:
            continue
        written = int(name.split("-")[1]) / 1e9
        if name in named or time.time() - written > _ABANDONED:
            table.below(name).delete()
    log.forget_before(kept[0])


def _create(spark: SparkSession, table: str, path: str, partition_by: str | None = None) -> None:
    """A table over a version's folder; what it is partitioned by shows in the folder names."""
    found = spark.read.parquet(path).schema
    names = _Folder(spark, path).names()
    partition_by = partition_by or next((n.split("=")[0] for n in names if "=" in n), None)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found)
    parts = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def layer_names(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The layers that exist, by name."""
    wanted = [database(layer, prefix) for layer in LAYERS]
    return (
        spark.sql("SHOW DATABASES")
        .where(F.col("namespace").isin(wanted))
        .select(F.col("namespace").alias("schema_name"))
        .orderBy("schema_name")
    )


def layer_tables(spark: SparkSession, layer: str, prefix: str = "") -> DataFrame:
    """Tables of one layer, by name."""
    return (
        spark.sql(f"SHOW TABLES IN `{database(layer, prefix)}`")
        .where(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
        .orderBy("table_name")
    )


def _table_folder(spark: SparkSession, layer: str, name: str, prefix: str) -> _Folder:
    return _Folder(spark, spark.catalog.getDatabase(database(layer, prefix)).locationUri).below(name)


def read_table(spark: SparkSession, layer: str, name: str, prefix: str = "") -> DataFrame:
    """The table's current version."""
    try:
        return spark.table(f"`{database(layer, prefix)}`.`{name}`")
    except AnalysisException:
        versions = _published(_table_folder(spark, layer, name, prefix))
        if not versions:
            raise
        return spark.read.parquet(versions[-1].path)  # the catalog is being changed


def has_table(spark: SparkSession, layer: str, name: str, prefix: str = "") -> bool:
    return spark.catalog.tableExists(f"`{database(layer, prefix)}`.`{name}`")


def work_path(spark: SparkSession, name: str) -> str:
    """A place of this application in the shared work folder."""
    return f"{work_root(spark)}/tallyhouse/{spark.conf.get('spark.app.id')}/{name}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared work folder and go on from the files."""
    path = work_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a query are deleted as soon as it ends; else they stay until the
    driver happens to collect its garbage, and those of many queries are on disk at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Steps:
    """Intermediate results of one load, each computed from nothing else that is kept here but the one before,
    which is deleted once the next is written. A query that is cut in this way has the shuffle files of one of
    its parts on disk and not those of all."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._last: _Folder | None = None

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        folder = _Folder(self._spark, work_path(self._spark, f"{name}-{uuid.uuid4().hex}"))
        try:
            df.write.option("compression", _CODEC).parquet(folder.path)
        except BaseException:
            folder.delete()
            raise
        self.drop()
        self._last = folder
        return self._spark.read.schema(df.schema).parquet(folder.path)

    def drop(self) -> None:
        if self._last:
            self._last.delete()
        self._last = None


def last_commit(spark: SparkSession, layer: str, name: str, prefix: str = "") -> int:
    """What ``publish`` takes as ``since``."""
    return _log_of(spark, _table_folder(spark, layer, name, prefix)).last()


def publish(
    df: DataFrame,
    layer: str,
    name: str,
    prefix: str = "",
    partition_by: str | None = None,
    reload: bool = True,
    identity: str | None = None,
    check: Callable[[DataFrame], list[str]] | None = None,
    rebalanced: bool = False,
    since: int | None = None,
) -> DataFrame:
    """Replace a table by a new version, then return it as read back. Raises ``ConflictingWrite`` where
    another load has committed since this one began; that one's rows stay. A load that has computed parts of
    ``df`` before says with ``since`` where it began.

    With ``partition_by`` the rows are rebalanced by that column first, so that each partition
    gets few, even files; AQE cuts a partition value that holds much of the data into several
    tasks; ``rebalanced`` says that the plan does so itself. ``identity`` names a row id that is given after the last shuffle, by the tasks that
    write: a repeated task replaces its rows and ids together. ``check`` gets the written rows and returns what is
    wrong with them; if anything is, the version is deleted and the table stays as it was.

    The staging layer is the auditable source of the others: with ``reload=False`` a table of it
    that exists is not replaced.
    """
    spark = df.sparkSession
    exists = has_table(spark, layer, name, prefix)
    if layer == STAGING and not reload and exists:
        raise ValueError(f"staging table {name} is kept across reloads")
    folder = _table_folder(spark, layer, name, prefix)
    log = _log_of(spark, folder)
    start = log.last() if since is None else since
    version = folder.below(f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    if partition_by and not rebalanced:
        df = df.hint("rebalance", F.col(partition_by))
    if identity:
        df = insert_identity(df, identity)
    try:
        writer = df.write.option("compression", _CODEC)
        writer = writer.partitionBy(partition_by) if partition_by else writer
        writer.parquet(version.path)
        wrong = check(spark.read.parquet(version.path)) if check else []
        if wrong:
            raise LoadRefused(f"{layer}.{name}: " + "; ".join(wrong))
        log.commit(start, {"version": version.path.rsplit("/", 1)[1]})
    except BaseException:
        version.delete()
        raise

    base = f"`{database(layer, prefix)}`."
    table, coming, going = (f"{base}`{name}{end}`" for end in ("", "__next", "__last"))
    for left_over in (coming, going):
        spark.sql(f"DROP TABLE IF EXISTS {left_over}")
    _create(spark, coming, version.path, partition_by)
    if exists:
        spark.sql(f"ALTER TABLE {table} RENAME TO {going}")
    spark.sql(f"ALTER TABLE {coming} RENAME TO {table}")
    if exists:
        spark.sql(f"DROP TABLE {going}")
    _clean_up(folder, log)
    return read_table(spark, layer, name, prefix)
