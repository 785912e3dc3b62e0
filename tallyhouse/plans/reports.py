"""Dashboard questions over the mart.

A small dimension is broadcast and its attribute grouped at once. Before a large one the fact is
summed to the dimension's key, so the join sees one row per member, and no popular product or
store can weigh on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import dates
from tallyhouse.functions.measures import average, recomputed, report, safe_ratio, total
from tallyhouse.operators.skew import skew_join
from tallyhouse.session import fits_broadcast

WIDE_MONEY = "decimal(38,2)"


def finance_dataset(monthly: DataFrame, dim_month: DataFrame, dim_product: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Monthly fact with its three dimensions and the first day of the month."""
    joined = skew_join(monthly, dim_month.withColumnRenamed("month_id", "month_fk"), "month_fk")
    joined = skew_join(joined, dim_product.withColumnRenamed("product_pk", "product_fk"), "product_fk", probe=monthly)
    joined = skew_join(joined, dim_store.withColumnRenamed("store_pk", "store_fk"), "store_fk", probe=monthly)
    return joined.select(
        F.col("month_fk").alias("month_id"),
        dates.month_start("month_fk").alias("month_start_date"),
        "month_name",
        "quarter",
        "year",
        "product_fk",
        "product_category_name_english",
        "store_fk",
        "store_city",
        "store_state",
        "quantity",
        "revenue",
        "cost",
        "profit",
    )


def by_attribute(
    fact: DataFrame, fk: str, dim: DataFrame, pk: str, attributes: list[str], measures: list[str]
) -> DataFrame:
    """Additive measures by attributes of one dimension."""
    members = dim.select(F.col(pk).alias(fk), *attributes)
    if fits_broadcast(members):
        return report(fact.join(F.broadcast(members), fk), attributes, measures)
    return report(report(fact, [fk], measures).join(members, fk), attributes, measures)


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return report(monthly.withColumnRenamed("month_fk", "month_id"), ["month_id"], ["revenue", "profit"]).orderBy("month_id")


def profit_margin(monthly: DataFrame) -> DataFrame:
    return monthly.agg(recomputed("profit_margin").alias("profit_margin"))


def profit_margin_by_month(monthly: DataFrame) -> DataFrame:
    return report(monthly.withColumnRenamed("month_fk", "month_id"), ["month_id"], ["profit_margin"]).orderBy("month_id")


def _by_category(monthly: DataFrame, dim_product: DataFrame, measures: list[str]) -> DataFrame:
    return by_attribute(
        monthly, "product_fk", dim_product, "product_pk", ["product_category_name_english"], measures
    )


def revenue_by_category(monthly: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _by_category(monthly, dim_product, ["revenue"]).orderBy(F.desc("revenue"), "product_category_name_english")


def profit_by_category(monthly: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _by_category(monthly, dim_product, ["profit"]).orderBy(F.desc("profit"), "product_category_name_english")


def unit_price_by_category(monthly: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Average price per unit, recomputed from the sums."""
    return _by_category(monthly, dim_product, ["revenue", "quantity"]).select(
        "product_category_name_english", safe_ratio(F.col("revenue"), F.col("quantity")).alias("unit_price")
    )


def revenue_by_city(monthly: DataFrame, dim_store: DataFrame) -> DataFrame:
    return by_attribute(monthly, "store_fk", dim_store, "store_pk", ["store_city"], ["revenue"]).orderBy(
        F.desc("revenue"), "store_city"
    )


def profit_by_category_region(monthly: DataFrame, dim_product: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Profit by product category and store state."""
    categories = dim_product.select(F.col("product_pk").alias("product_fk"), "product_category_name_english")
    stores = dim_store.select(F.col("store_pk").alias("store_fk"), "store_state")
    sales = monthly
    if not fits_broadcast(categories):
        sales = report(monthly, ["product_fk", "store_fk"], ["profit"])
    sales = skew_join(sales, categories, "product_fk", probe=monthly)
    if not fits_broadcast(stores):
        # One row per category and store: no store is hot from here on.
        sales = report(sales, ["product_category_name_english", "store_fk"], ["profit"])
    return report(sales.join(stores, "store_fk"), ["product_category_name_english", "store_state"], ["profit"]).orderBy(
        F.desc("profit"), "product_category_name_english", "store_state"
    )


def avg_days_to_deliver(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(average("days_to_deliver").alias("avg_days_to_deliver"))


def fulfilment_stage_averages(snapshot: DataFrame) -> DataFrame:
    """Average of each stage by order status: where the time goes."""
    return report(snapshot, ["order_status"], ["days_to_approve", "days_to_ship", "days_to_deliver"]).orderBy("order_status")


def ytd_revenue(monthly: DataFrame, dim_month: DataFrame) -> DataFrame:
    """Running revenue within each year over the months with sales.

    The window runs over monthly totals, at most twelve rows a year.
    """
    per_month = monthly.groupBy(F.col("month_fk").alias("month_id")).agg(total("revenue").alias("revenue"))
    running = (
        Window.partitionBy("year")
        .orderBy("month_start_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        per_month.join(dim_month.select("month_id", "year"), "month_id")
        .withColumn("month_start_date", dates.month_start("month_id"))
        .select(
            "year",
            "month_id",
            "month_start_date",
            "revenue",
            F.sum("revenue").over(running).cast(WIDE_MONEY).alias("ytd_revenue"),
        )
        .orderBy("month_id")
    )


def fulfilment_role_dates(snapshot: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Snapshot with the date dimension in four roles."""
    rows = snapshot
    for role in ("order", "approved", "shipped", "delivered"):
        days = dim_date.select(
            F.col("date_id").alias(f"{role}_date_fk"),
            F.col("full_date").alias(f"{role}_date"),
            F.col("day_name").alias(f"{role}_day_name"),
            F.col("weekday_flag").alias(f"{role}_weekday_flag"),
        )
        rows = skew_join(rows, days, f"{role}_date_fk", "left", probe=snapshot)
    return rows
