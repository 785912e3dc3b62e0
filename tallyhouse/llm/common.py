"""Helpers that the operators share: tables, row numbers, intermediate results, Arrow text."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.layers import cut_lineage, work_path

__all__ = ["cut_lineage", "few_rows", "free_name", "numbered", "read", "slices", "small_batches", "text_buffer", "work_path"]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def _is_scan(df: DataFrame) -> bool:
    """Whether each row of ``df`` is one row of a file: nothing but columns and filters on a scan."""
    try:
        plan = df._jdf.queryExecution().analyzed()
        while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
            plan = plan.children().head()
        return plan.nodeName() == "LogicalRelation"
    except (AttributeError, Py4JError):
        return False


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a number each that stays the same in every scan, and its column's name.

    Rows need an identity of their own, as doc_id may be null or repeated. Rows of files are
    numbered by file and place in the file; anything else is first written with a number. Either
    way a retried task or a second scan sees the same one.
    """
    row = free_name(df, "_row")
    files: list[str] = []
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        if _is_scan(df):
            files = sorted(r[0] for r in placed.select("_file").distinct().toLocalIterator())
    except AnalysisException:
        pass
    if not files or {"_file", "_at"} & {c.lower() for c in df.columns}:
        return cut_lineage(df.withColumn(row, F.monotonically_increasing_id()), name), row
    # One entry per file; the driver lists them for any scan.
    table = pa.table({"_file": pa.array(files), "_no": pa.array(range(len(files)), pa.int64())})
    known = F.broadcast(df.sparkSession.createDataFrame(table))
    number = F.coalesce(F.shiftleft("_no", 40) + F.col("_at"), F.raise_error(F.concat(F.lit("unlisted file "), "_file")))
    return placed.join(known, "_file", "left").select(*[f"`{c}`" for c in df.columns], number.cast("long").alias(row)), row


FEW = 500_000


def few_rows(df: DataFrame) -> DataFrame:
    """The side of a join against a wide table: copied to all executors when a count shows that it
    is small (it must be a stored table of a few numbers a row), else hashed after a shuffle."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df.hint("shuffle_hash")


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within the block, Arrow batches hold few rows, as each row may be a very long text."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and where each text starts (nulls: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    n, first = len(column), column.offset
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64, n + 1, first * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
