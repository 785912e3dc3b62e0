"""Questions the requirements ask for beyond the warehouse as scripted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import dates
from tallyhouse.functions.clean import UNKNOWN_DATE_KEY, UNKNOWN_KEY, UNKNOWN_CATEGORY
from tallyhouse.functions.measures import safe_ratio
from tallyhouse.operators.keys import assign_keys, with_unknown
from tallyhouse.operators.skew import skew_join
from tallyhouse.plans.reports import WIDE_MONEY

# Share of orders per channel, in percent.
CHANNEL_SHARES = {"Website": 50, "App": 30, "Pop-up store": 20}
# Channel by payment type.
CHANNEL_OF_PAYMENT = {"card": "Website", "transfer": "Website", "wallet": "App", "voucher": "Pop-up store"}
#: Channel of orders whose payment type no list names.
UNLISTED_CHANNEL = "Other"


def assign_channel(df: DataFrame, shares: dict[str, int] | None = None) -> DataFrame:
    """Give each order a channel in fixed proportions, from a digest of its id.

    All lines of an order, in any table and load, get the same channel.
    """
    shares = shares or CHANNEL_SHARES
    if sum(shares.values()) != 100:
        raise ValueError("channel shares must add up to 100")
    point = (F.conv(F.substring(F.md5("order_id"), 1, 6), 16, 10).cast("int") % 100)
    names, upper = list(shares), 0
    channel = None
    for name in names[:-1]:
        upper += shares[name]
        channel = F.when(point < upper, name) if channel is None else channel.when(point < upper, name)
    channel = F.lit(names[-1]) if channel is None else channel.otherwise(names[-1])
    return df.withColumn("channel", channel)


def channel_of_payments(payments: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Channel per order from the type of its first payment; types that the mapping lacks have a
    channel of their own."""
    mapping = mapping or CHANNEL_OF_PAYMENT
    first = payments.groupBy("order_id").agg(
        F.min_by("payment_type", F.struct(F.col("payment_sequential").cast("int"), F.col("payment_type"))).alias("payment_type")
    )
    channel = F.lit(UNLISTED_CHANNEL)
    for payment_type, name in mapping.items():
        channel = F.when(F.col("payment_type") == payment_type, name).otherwise(channel)
    return first.select("order_id", channel.alias("channel"))


def _dated(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("date_fk") != UNKNOWN_DATE_KEY)


def daily_by_channel(fact: DataFrame) -> DataFrame:
    """Revenue and lines by day and channel: the small frame under the running totals."""
    return (
        _dated(fact)
        .groupBy("channel", "date_fk")
        .agg(F.sum("sales_amount").cast(WIDE_MONEY).alias("revenue"), F.count(F.lit(1)).alias("order_lines"))
    )


def mtd_revenue_by_channel(fact: DataFrame) -> DataFrame:
    """Running revenue within each month; the window holds at most 31 daily totals."""
    running = (
        Window.partitionBy("channel", "month_id")
        .orderBy("date_fk")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        daily_by_channel(fact)
        .withColumn("month_id", dates.month_of_date_key("date_fk"))
        .select(
            "channel",
            "month_id",
            "date_fk",
            "revenue",
            F.sum("revenue").over(running).cast(WIDE_MONEY).alias("mtd_revenue"),
        )
    )


def yoy_growth_by_channel(fact: DataFrame) -> DataFrame:
    """Yearly revenue against the calendar year before; NULL where that year has no sales."""
    yearly = (
        _dated(fact)
        .groupBy("channel", F.floor(F.col("date_fk") / 10000).cast("int").alias("year"))
        .agg(F.sum("sales_amount").cast(WIDE_MONEY).alias("revenue"))
    )
    before = yearly.select("channel", (F.col("year") + 1).alias("year"), F.col("revenue").alias("previous_revenue"))
    change = F.col("revenue").cast("double") - F.col("previous_revenue").cast("double")
    return yearly.join(before, ["channel", "year"], "left").select(
        "channel", "year", "revenue", "previous_revenue", safe_ratio(change, F.col("previous_revenue")).alias("growth")
    )


def avg_order_value_by_segment(fact: DataFrame, dim_customer: DataFrame, segments: DataFrame) -> DataFrame:
    """Average order total by customer segment.

    Orders are summed to customers first, so the join has one row per customer.
    """
    per_order = fact.groupBy("order_id", "customer_fk").agg(F.sum("sales_amount").alias("order_value"))
    per_customer = per_order.groupBy("customer_fk").agg(
        F.sum("order_value").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    customers = skew_join(dim_customer.select("customer_id", F.col("customer_pk").alias("customer_fk")), segments, "customer_id", "left")
    return (
        per_customer.join(customers.select("customer_fk", "segment"), "customer_fk", "left")
        .groupBy(F.coalesce("segment", F.lit("Unknown")).alias("segment"))
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
        .select("segment", "orders", safe_ratio(F.col("revenue"), F.col("orders")).alias("avg_order_value"))
    )


def daily_channel_snapshot(fact: DataFrame, dim_date: DataFrame, channels: list[str] | None = None) -> DataFrame:
    """One row per day and channel, zero where nothing was sold.

    The channels are the listed ones and any others of the fact, and a day with sales has its rows
    also where the calendar lacks it, so the revenue is that of the fact.
    """
    daily = daily_by_channel(fact)
    listed = fact.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(c) for c in channels or CHANNEL_SHARES])).alias("channel")
    )
    names = listed.union(daily.select("channel")).distinct().agg(F.collect_set("channel").alias("names"))
    days = dim_date.where(F.col("date_id") != UNKNOWN_DATE_KEY).select(F.col("date_id").alias("date_fk"))
    days = days.union(daily.select("date_fk")).distinct()
    grid = days.join(F.broadcast(names)).select("date_fk", F.explode("names").alias("channel"))
    return grid.join(daily, ["date_fk", "channel"], "left").select(
        "date_fk",
        "channel",
        F.coalesce("revenue", F.lit(0)).cast(WIDE_MONEY).alias("revenue"),
        F.coalesce("order_lines", F.lit(0)).alias("order_lines"),
    )


def build_dim_product_category(dim_product: DataFrame) -> DataFrame:
    """Category as a dimension of its own."""
    categories = (
        dim_product.where(F.col("product_pk") != UNKNOWN_KEY)
        .select(F.col("product_category_name_english").alias("category_name"))
        .where(F.col("category_name") != UNKNOWN_CATEGORY)
        .distinct()
    )
    return with_unknown(
        assign_keys(categories, "category_pk"), {"category_pk": UNKNOWN_KEY, "category_name": UNKNOWN_CATEGORY}
    )


def products_with_category(dim_product: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Product dimension with the category key in place of its name."""
    keys = dim_category.select(
        F.col("category_name").alias("product_category_name_english"), F.col("category_pk").alias("category_fk")
    )
    return skew_join(dim_product, keys, "product_category_name_english", "left").select(
        "product_pk", "product_id", F.coalesce("category_fk", F.lit(UNKNOWN_KEY)).cast("long").alias("category_fk")
    )


