"""Rows that would fail a load, routed aside with the reason in the one write that also keeps the others."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.clean import SIZE_DECIMAL, blank_to_null, text_to_date, text_to_decimal
from tallyhouse.plans.dims import MILESTONES, SIZES
from tallyhouse.plans.facts import line_reject_reason

REASON = "reject_reason"
_LOADS = "_loads"


def _bad(column: str, value: Column) -> Column:
    return blank_to_null(column).isNotNull() & value.isNull()


def order_reject_reason() -> Column:
    """Orders need an id and dates that are dates; blank milestones are still to come."""
    reason = F.when(blank_to_null("order_id").isNull(), "blank order_id")
    for name, column in MILESTONES.items():
        reason = reason.when(_bad(column, text_to_date(column, "lenient")), f"bad {name}")
    return reason


def product_reject_reason() -> Column:
    """Products need an id and sizes that are numbers, of no more digits than are kept."""
    reason = F.when(blank_to_null("product_id").isNull(), "blank product_id")
    for column in SIZES:
        reason = reason.when(_bad(column, text_to_decimal(column, SIZE_DECIMAL, "lenient")), f"bad {column}")
    return reason


REASONS: dict[str, Callable[[], Column]] = {
    "raw_orders": order_reject_reason,
    "raw_products": product_reject_reason,
    "raw_order_items": line_reject_reason,
}


@dataclass(frozen=True)
class Routed:
    """A raw table after routing: rows that load, the others with their reason, and how many of each."""

    loaded: DataFrame
    rejects: DataFrame
    rows_read: int
    rows_loaded: int

    @property
    def rows_rejected(self) -> int:
        return self.rows_read - self.rows_loaded


def route(spark: SparkSession, raw: DataFrame, reason: Column, path: str) -> Routed:
    """Writes each row of ``raw`` once below ``path``, by whether it loads; rows are counted while they
    are written. Nothing is shuffled and nothing read twice."""
    marked = raw.withColumn(REASON, reason).withColumn(_LOADS, F.col(REASON).isNull())
    seen = Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(_LOADS).alias("loaded"))
    counted.write.partitionBy(_LOADS).parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    return Routed(
        stored.where(_LOADS).select(*raw.columns), stored.where(~F.col(_LOADS)).select(*raw.columns, REASON), seen.get["read"], seen.get["loaded"]
    )


def outcomes(routed: Routed) -> DataFrame:
    """Rows by outcome: loaded, or the reason why not."""
    loaded = routed.loaded.agg(F.count(F.lit(1)).alias("n")).select(F.lit("loaded").alias("outcome"), "n")
    return loaded.unionByName(routed.rejects.groupBy(F.col(REASON).alias("outcome")).agg(F.count(F.lit(1)).alias("n")))
