"""Surrogate keys, unknown members, seed rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET_DIGITS = 4  # 16**4 = 65,536 key buckets
_COPIES_PER_TASK = 1 << 20

#: Writes an intermediate result under a name and goes on from what was written.
Keep = Callable[[DataFrame, str], DataFrame]


def row_digest(columns: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def _bucket(columns: list[str]) -> Column:
    return F.conv(F.substring(row_digest(columns), 1, _BUCKET_DIGITS), 16, 10).cast("int")


def first_keys(counted: DataFrame, columns: list[str], count: str, keep: Keep | None = None) -> DataFrame:
    """Adds ``_first``, the first of ``count`` keys for each row, dense from 1 in the order of a digest.

    The key of a row depends on the data only: not on partitioning, retries or the load before.
    Rows fall into buckets by the first digest digits; a key is the rows in lower buckets plus the
    position in the own bucket. Digests spread evenly, so buckets are even however the natural
    keys are distributed, and only the bucket sizes (at most 65,536 rows) meet in one place.

    Without ``keep`` the input is computed twice, for the bucket sizes too. With it rows are written
    when they have their place in the bucket, and the sizes are read from there.
    """
    bucketed = counted.withColumn("_b", _bucket(columns))
    placed = _in_bucket(bucketed.repartition("_b"), columns, count)
    if keep is None:
        sizes = bucketed.groupBy("_b").agg(F.sum(count).alias("_size"))
    else:
        placed, sizes = _kept(placed, keep)
    return _after_lower_buckets(placed, sizes, count).select("_first", *counted.columns)


def _in_bucket(moved: DataFrame, columns: list[str], count: str) -> DataFrame:
    """Adds ``_last``, the position in the bucket up to which a row goes. Rows have moved by bucket before they
    get the digest, which random as it is would double what is moved."""
    up_to_here = (
        Window.partitionBy("_b").orderBy("_d", *columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return moved.withColumn("_d", F.unhex(row_digest(columns))).withColumn("_last", F.sum(count).over(up_to_here)).drop("_d")


def _kept(placed: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in the bucket, written, and the bucket sizes."""
    placed = keep(placed, "placed")
    return placed, placed.groupBy("_b").agg(F.max("_last").alias("_size"))


def _after_lower_buckets(placed: DataFrame, sizes: DataFrame, count: str) -> DataFrame:
    lower = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over bucket sizes only
    offsets = sizes.select("_b", F.coalesce(F.sum("_size").over(lower), F.lit(0)).alias("_offset"))
    first = F.col("_offset") + F.col("_last") - F.col(count) + 1
    return placed.join(F.broadcast(offsets), "_b").withColumn("_first", first)


def unrolled(runs: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One row per key, from runs of ``_n`` keys from ``_first`` on. Long runs are cut into chunks,
    which spread over the tasks."""
    placed = runs.select("_first", "_n", *columns)
    few = placed.where(F.col("_n") <= _COPIES_PER_TASK).withColumn("_from", F.lit(0).cast("long"))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_COPIES_PER_TASK).cast("long")))
    many = (
        placed.where(F.col("_n") > _COPIES_PER_TASK)
        .withColumn("_from", chunks)
        .repartition("_first", "_from")
    )
    last_copy = F.least(F.col("_from") + _COPIES_PER_TASK, F.col("_n")) - 1
    return (
        few.unionByName(many)
        .withColumn("_copy", F.explode(F.sequence(F.col("_from"), last_copy)))
        .select((F.col("_first") + F.col("_copy")).alias(name), *columns)
    )


def assign_keys(
    df: DataFrame, name: str, columns: list[str] | None = None, unique: bool = True, keep: Keep | None = None
) -> DataFrame:
    """Dense keys 1..N in the order of a digest of the row (see ``first_keys``).

    ``unique=False`` allows whole-row copies: they are counted before the shuffle and numbered
    from the count, so a large group of copies never sorts in one task.
    """
    columns = columns or df.columns
    if unique:
        placed = first_keys(df.withColumn("_n", F.lit(1).cast("long")), columns, "_n", keep)
        return placed.select(F.col("_first").alias(name), *df.columns)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return unrolled(first_keys(counted, columns, "_n", keep), name, df.columns)


def assign_group_keys(df: DataFrame, name: str, columns: list[str], sums: dict[str, Column], keep: Keep) -> DataFrame:
    """``assign_keys`` of the groups of ``df`` by ``columns``, with one shuffle: rows move to the bucket of their
    group and are summed there. They are not summed before they move, so this is for groups of few rows."""
    moved = df.withColumn("_b", _bucket(columns)).repartition("_b")
    grouped = moved.groupBy("_b", *columns).agg(F.lit(1).cast("long").alias("_n"), *[s.alias(c) for c, s in sums.items()])
    placed = _after_lower_buckets(*_kept(_in_bucket(grouped, columns, "_n"), keep), "_n")
    return placed.select(F.col("_first").alias(name), *columns, *sums)


def insert_identity(df: DataFrame, name: str) -> DataFrame:
    """Unique row ids given while the rows are written, without a shuffle. For facts, whose row
    ids nothing refers to; use ``assign_keys`` where a rebuild must give the same keys."""
    return df.select((F.monotonically_increasing_id() + 1).alias(name), *df.columns)


def literal_row(df: DataFrame, row: dict) -> DataFrame:
    """One row with the schema of ``df``; columns not named are NULL."""
    return df.sparkSession.range(0, 1, 1, 1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )


def with_unknown(dim: DataFrame, row: dict) -> DataFrame:
    """Add the member that unmatched foreign keys point to."""
    return dim.unionByName(literal_row(dim, row))


def insert_if_absent(df: DataFrame, rows: list[dict], key: str) -> DataFrame:
    """Add each seed row whose key is not there yet.

    The seeds are literals, so they are the side to broadcast; ``df`` is filtered, not shuffled.
    """
    seeds = literal_row(df, rows[0])
    for row in rows[1:]:
        seeds = seeds.unionByName(literal_row(df, row))
    seeds = seeds.dropDuplicates([key])
    present = df.join(F.broadcast(seeds.select(key)), key, "left_semi").select(key).distinct()
    return df.unionByName(seeds.join(present, key, "left_anti").select(*df.columns))
