"""Upkeep of the order fulfilment snapshot as orders progress.

Milestones only ever become known, and the earliest report of one stands. ``min`` over all
reports of an order says just that: it ignores NULLs, so a late or repeated report cannot blank a
milestone, and it may be applied in any order and any number of times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.functions.clean import UNKNOWN_KEY, text_to_date
from tallyhouse.plans.dims import MILESTONES
from tallyhouse.plans.facts import build_fulfilment, resolve_orders
from tallyhouse.sources.merged import BUCKETS, MergedTable
from tallyhouse.sources.schemas import RAW_SCHEMAS

# How far each status is along the way. The last two end an order whatever came before.
STATUS_RANK = {
    "created": 1,
    "approved": 2,
    "invoiced": 3,
    "processing": 4,
    "shipped": 5,
    "delivered": 6,
    "unavailable": 7,
    "canceled": 8,
}

_STATE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        *[T.StructField(name, T.DateType()) for name in MILESTONES],
        T.StructField("order_status", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _rank(status: Column) -> Column:
    """Place of a status; blank or missing comes first, and an unknown one fails, as nobody can say where it
    belongs."""
    unknown = F.raise_error(F.concat(F.lit("unknown order status: "), status)).cast("int")
    rank = F.when(F.coalesce(status, F.lit("")) == "", 0)
    for name, value in STATUS_RANK.items():
        rank = rank.when(status == name, value)
    return rank.otherwise(unknown)


def order_reports(raw_orders: DataFrame, mode: str = "strict") -> DataFrame:
    """Raw order rows as reports with typed milestones."""
    return raw_orders.select(
        "order_id",
        "customer_id",
        *[text_to_date(column, mode).alias(name) for name, column in MILESTONES.items()],
        "order_status",
    )


def merge_milestones(reports: DataFrame) -> DataFrame:
    """One row per order. Reports are merged before the shuffle, so an order reported over and
    over is no hot spot."""
    return reports.groupBy("order_id").agg(
        F.max("customer_id").alias("customer_id"),
        *[F.min(name).alias(name) for name in MILESTONES],
        F.max(F.struct(_rank(F.col("order_status")).alias("r"), F.col("order_status").alias("s"))).alias("_status"),
    ).withColumn("order_status", F.col("_status.s")).drop("_status")


def fulfilment_upsert(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Snapshot after a batch of reports; applying a batch twice changes nothing."""
    return merge_milestones(state.unionByName(batch))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Current snapshot: all reports kept under ``path``, merged."""
    return merge_milestones(spark.read.schema(_STATE).parquet(path).drop("batch_id"))


def follow_orders(spark: SparkSession, source: str, state: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Stream raw order files (parquet) into the state.

    A batch writes its own folder, merged within the batch only, so its cost does not grow with
    the state. The folder carries the batch id: a replayed batch replaces itself.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        merge_milestones(order_reports(batch)).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")

    return (
        spark.readStream.schema(RAW_SCHEMAS["raw_orders"])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact_state(spark: SparkSession, state: str, target: str) -> None:
    """Fold the batches kept so far into one folder at a new place, for a follower to go on from."""
    read_state(spark, state).write.mode("overwrite").parquet(f"{target}/batch_id=-1")


def _latest_progress(reports: DataFrame) -> DataFrame:
    """One row per order of resolved reports: earliest milestones, the furthest status, and the customer
    of the latest report that knows one (of several the smallest key)."""
    known = F.struct((F.col("customer_fk") != UNKNOWN_KEY).alias("k"), "reported", (-F.col("customer_fk")).alias("c"))
    return reports.groupBy("order_id").agg(
        (-F.max(known)["c"]).alias("customer_fk"),
        *[F.min(name).alias(name) for name in MILESTONES],
        F.max(F.struct(_rank(F.col("order_status")).alias("r"), F.col("order_status").alias("s")))["s"].alias("order_status"),
        F.max("reported").alias("reported"),
    )


class FulfilmentSnapshot:
    """The accumulating snapshot as a stored table that batches of raw orders are merged into. Only the
    buckets of orders in a batch are written again."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.table = MergedTable(spark, path, "order_id", _latest_progress, buckets)

    def merge(self, raw_orders: DataFrame, dim_customer: DataFrame, report: int) -> int:
        """Merges a batch, numbered ``report`` in the order batches came in; repeating it changes nothing."""
        resolved = resolve_orders(raw_orders, dim_customer)
        return self.table.merge(resolved.withColumn("reported", F.lit(report).cast("long")))

    def read(self) -> DataFrame:
        """The snapshot: keys of customer and milestones, status and lags, one row per order."""
        return build_fulfilment(self.table.read().drop("reported"))

    def follow(self, source: str, dim_customer: DataFrame, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
        """Streams raw order files (parquet) into the snapshot. A replayed batch merges once more, which
        changes nothing."""
        spark = dim_customer.sparkSession
        return (
            spark.readStream.schema(RAW_SCHEMAS["raw_orders"])
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(source)
            .writeStream.foreachBatch(lambda batch, number: self.merge(batch, dim_customer, number) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
