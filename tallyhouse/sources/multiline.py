"""Reading of CSV files whose quoted fields run over several lines.

Spark's own multi-line reader hands each file to one task, and turns CR LF inside a field into LF
where the file's lines end so. Here lines are read in splits; whether a line starts a record
follows from the number of quotes before it in the file, which is a sum per split and a running
sum over the splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.clean import null_to_blank

_SPLIT = ["file", "start"]


def _odd(quotes: Column) -> Column:
    return (F.coalesce(quotes, F.lit(0)) % 2).cast("int")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records of quoted CSV files as (file, start, pos, record); the first one of a file is its header."""
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"),
            F.col("value").alias("line"),
            (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        )
    )
    in_split = Window.partitionBy(*_SPLIT).orderBy("id")
    earlier_lines = in_split.rowsBetween(Window.unboundedPreceding, -1)
    earlier_splits = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    # One row per split: are the quotes open where it begins, and do all quotes of the file close?
    # An odd quote would make one record of all that follows it.
    opened = (
        lines.groupBy(*_SPLIT)
        .agg(_odd(F.sum("quotes")).alias("odd"))
        .select(
            *_SPLIT,
            _odd(F.sum("odd").over(earlier_splits)).alias("open"),
            _odd(F.sum("odd").over(Window.partitionBy("file"))).alias("never_closed"),
        )
    )
    stray = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file"))).cast("boolean")
    opened = opened.where(F.when(F.col("never_closed") == 0, True).otherwise(stray)).drop("never_closed")
    placed = (
        lines.withColumn("pos", F.row_number().over(in_split))
        .withColumn("odd_before", _odd(F.sum("quotes").over(earlier_lines)))
        .join(opened, _SPLIT)
        .withColumn("first", F.when(F.col("odd_before") == F.col("open"), F.struct("start", "pos")))
        .select(*_SPLIT, "pos", "line", "first")
    )
    # A split that begins inside a record continues the last one that started before it.
    before = (
        placed.groupBy(*_SPLIT)
        .agg(F.max("first").alias("last_first"))
        .select(*_SPLIT, F.last("last_first", ignorenulls=True).over(earlier_splits).alias("carried"))
    )
    so_far = Window.partitionBy(*_SPLIT).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = placed.withColumn("own", F.last("first", ignorenulls=True).over(so_far)).join(before, _SPLIT)
    in_order = F.array_sort(F.collect_list(F.struct("start", "pos", "line")))
    return (
        owned.withColumn("record", F.coalesce("own", "carried"))
        .groupBy("file", "record")
        .agg(in_order.alias("lines"))
        .select(
            "file",
            "record.start",
            "record.pos",
            F.rtrim(F.array_join(F.col("lines.line"), "\n"), F.lit("\r")).alias("record"),
        )
    )


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All-text rows of RFC 4180 files, each file read by as many tasks as it has splits."""
    names = schema.fieldNames()
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    rows = (
        records(spark, path)
        .where(F.col("record") != "")
        .withColumn("row", F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), options))
    )
    is_header = (F.col("start") == 0) & (F.col("pos") == 1)
    header = F.concat_ws(",", *[F.col(f"row.{c}") for c in names])
    wrong = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), header))
    checked = rows.where(F.when(~is_header, True).when(header == ",".join(names), False).otherwise(wrong.cast("boolean")))
    return checked.select(*[null_to_blank(F.col(f"row.{c}")).alias(c) for c in names])
