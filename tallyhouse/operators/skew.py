"""Equi-joins that stay balanced when one key holds a large share of either side."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import fits_broadcast, shuffle_width

_TRACKED = 8192  # least entries of the heavy-hitter sketch; it has four for each key that may qualify
_MOST_TRACKED = 1 << 20
_SKETCH_GROUPS = 64  # sketches are merged in two steps so that no task merges one per input split


def hot_keys(sides: list[DataFrame], key: str, slices_of: int) -> list[dict]:
    """Per side, the keys holding more than ``1 / slices_of`` of its rows, with the slices each is
    cut into.

    One pass with a frequent-items sketch per input split, so no row is shuffled. Fewer than
    ``slices_of`` keys of a side can qualify, which bounds what reaches the driver. A missed key
    costs balance only, never correctness.
    """
    tracked = min(_MOST_TRACKED, max(_TRACKED, 4 * slices_of))
    keys = reduce(DataFrame.unionByName, [df.select(key, F.lit(i).alias("side")) for i, df in enumerate(sides)])
    partial = (
        keys.where(F.col(key).isNotNull())
        .groupBy("side", (F.spark_partition_id() % _SKETCH_GROUPS).alias("g"))
        .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("s"))
    )
    merged = partial.groupBy("side").agg(
        F.sum("n").alias("n"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {min(slices_of, tracked)})").alias("top"),
    )
    slices = F.least(F.ceil(F.col("t.count") * slices_of / F.col("n")).cast("int"), F.lit(slices_of))
    listed = (
        merged.select("side", "n", F.explode("top").alias("t"))
        .select("side", F.col("t.item").alias("item"), slices.alias("slices"))
        .where(F.col("slices") > 1)
        .collect()
    )
    return [{row["item"]: row["slices"] for row in listed if row["side"] == i} for i in range(len(sides))]


def _noise(columns: list[str]) -> Column:
    """Spreads equal keys, even exact copies. Unlike ``rand()`` it gives a recomputed input split
    the same values again, so a retried task cannot lose or repeat rows."""
    return F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in columns])


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    probe: DataFrame | None = None,
    right_probe: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` for inner and left joins, balanced under hot keys.

    A side whose size is checked to be small is broadcast: no shuffle, no skew. Otherwise both
    sides are shuffled, and a key that is hot on one side is cut into slices there while its rows
    on the other side are repeated for each slice. NULL keys, which never match, are spread too.

    ``probe`` and ``right_probe`` name cheaper frames with the keys of a side, so that looking for
    hot keys does not compute the side itself. For a left join each key of ``right_probe`` must
    occur in ``right``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join does inner and left joins, not {how!r}")
    columns = [*left.columns, *[c for c in right.columns if c != on]]
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how).select(*columns)
    if how == "inner" and fits_broadcast(left):
        return F.broadcast(left).join(right, on).select(*columns)

    width = max(2, shuffle_width(left.sparkSession))
    probes = [left if probe is None else probe, right if right_probe is None else right_probe]
    hot_left, hot_right = hot_keys(probes, on, width)
    # The hint keeps to the size check above; a merge join spills where a hash table would not fit.
    if not hot_left and not hot_right:
        if how == "inner":
            return left.join(right.hint("merge"), on).select(*columns)
        spread = left.withColumn("_a", _null_slice(left, on, width))
        return spread.join(right.withColumn("_a", F.lit(0)).hint("merge"), [on, "_a"], how).select(*columns)

    hot = _hot_frame(left, on, hot_left, hot_right)

    def slice_of(side: DataFrame, count: str) -> Column:
        return F.pmod(_noise(side.columns), F.coalesce(F.col(count), F.lit(1))).cast("int")

    def every_slice(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1))

    sliced_left = (
        left.join(hot, on, "left")
        .withColumn("_a", F.when(F.col(on).isNull(), _null_slice(left, on, width)).otherwise(slice_of(left, "_l")))
        .withColumn("_b", every_slice("_r") if hot_right else F.lit(0))
        .withColumn("_right_hot", F.col("_r").isNotNull())
        .drop("_l", "_r")
    )
    sliced_right = (
        right.where(F.col(on).isNotNull())
        .join(hot, on, "left")
        .withColumn("_b", slice_of(right, "_r"))
        .withColumn("_a", every_slice("_l") if hot_left else F.lit(0))
        .withColumn("_matched", F.lit(True))
        .drop("_l", "_r")
    )
    joined = sliced_left.join(sliced_right.hint("merge"), [on, "_a", "_b"], how)
    if how == "left":
        # A key hot on the right exists there, so a slice of it without a match is no real miss.
        joined = joined.where(~F.col("_right_hot") | F.col("_matched").isNotNull())
    return joined.select(*columns)


def _null_slice(side: DataFrame, on: str, width: int) -> Column:
    return F.when(F.col(on).isNull(), F.pmod(_noise(side.columns), F.lit(width)).cast("int")).otherwise(F.lit(0))


def _hot_frame(side: DataFrame, on: str, hot_left: dict, hot_right: dict) -> DataFrame:
    """The listed keys with their slices on either side, to broadcast: fewer than two per shuffle partition."""
    keys = list({**hot_left, **hot_right})
    table = pa.table(
        {
            "k": pa.array(keys),
            "_l": pa.array([hot_left.get(k) for k in keys], pa.int32()),
            "_r": pa.array([hot_right.get(k) for k in keys], pa.int32()),
        }
    )
    listed = side.sparkSession.createDataFrame(table)  # an Arrow table needs no Python worker
    return F.broadcast(listed.select(F.col("k").cast(side.schema[on].dataType).alias(on), "_l", "_r"))
