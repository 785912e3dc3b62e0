"""Core and mart dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import dates
from tallyhouse.functions.clean import (
    SIZE_DECIMAL,
    UNKNOWN_CATEGORY,
    UNKNOWN_DATE_KEY,
    UNKNOWN_KEY,
    category_or_unknown,
    clean_city,
    text_to_date,
    text_to_decimal,
)
from tallyhouse.operators.keys import assign_keys, with_unknown
from tallyhouse.operators.skew import skew_join

#: Gives the members a key column: (members, name, unique=...). ``assign_keys``, or ``KeyMap.keyed`` for keys that outlast loads.
GiveKeys = Callable[..., DataFrame]

MILESTONES = {
    "order_date": "order_purchase_timestamp",
    "approved_date": "order_approved_at",
    "shipped_date": "order_delivered_carrier_date",
    "delivered_date": "order_delivered_customer_date",
}


SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def fixed_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))


def data_bounds(orders: DataFrame, mode: str = "strict") -> DataFrame:
    """Whole years covering every milestone of the raw orders, as one row."""
    days = [text_to_date(c, mode) for c in MILESTONES.values()]
    first, last = F.min(F.least(*days)), F.max(F.greatest(*days))
    return orders.agg(
        F.trunc(first, "year").alias("start"), F.make_date(F.year(last), F.lit(12), F.lit(31)).alias("end")
    )


def build_dim_date(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per calendar day between two dates, and the unknown date.

    ``holidays`` (one column ``full_date``) sets the holiday flag, which is false otherwise.
    """
    day = F.col("full_date")
    calendar = (
        bounds.select(F.explode(F.sequence("start", "end")).alias("full_date"))
        .select(
            dates.date_key(day).alias("date_id"),
            "full_date",
            F.dayofmonth(day).alias("day"),
            dates.day_name(day).alias("day_name"),
            dates.is_weekday(day).alias("weekday_flag"),
            F.month(day).alias("month"),
            dates.month_name(day).alias("month_name"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
        )
    )
    if holidays is None:
        calendar = calendar.withColumn("is_holiday_flag", F.lit(False))
    else:
        marks = holidays.select("full_date", F.lit(True).alias("is_holiday_flag")).distinct()
        calendar = calendar.join(marks, "full_date", "left").select(
            "date_id",
            "full_date",
            "day",
            "day_name",
            "weekday_flag",
            "month",
            "month_name",
            "quarter",
            "year",
            F.coalesce("is_holiday_flag", F.lit(False)).alias("is_holiday_flag"),
        )
    return with_unknown(
        calendar,
        {
            "date_id": UNKNOWN_DATE_KEY,
            "full_date": "1900-01-01",
            "day": 1,
            "day_name": "Unknown",
            "weekday_flag": False,
            "month": 1,
            "month_name": "Unknown",
            "quarter": 1,
            "year": 1900,
            "is_holiday_flag": False,
        },
    )


def build_dim_customer(customers: DataFrame, give_keys: GiveKeys = assign_keys) -> DataFrame:
    """Distinct customers with a clean city. Two spellings of one customer stay two members."""
    members = customers.select(
        "customer_id",
        "customer_unique_id",
        clean_city("customer_city").alias("customer_city"),
        "customer_state",
        "customer_zip_code_prefix",
    ).distinct()
    return with_unknown(
        give_keys(members, "customer_pk"),
        {
            "customer_pk": UNKNOWN_KEY,
            "customer_id": "-1",
            "customer_unique_id": "-1",
            "customer_city": "Unknown",
            "customer_state": "Unknown",
            "customer_zip_code_prefix": "Unknown",
        },
    )


def translated_products(products: DataFrame, translation: DataFrame, mode: str = "strict") -> DataFrame:
    """Products with an English category and typed sizes, before keys are given."""
    joined = skew_join(
        products, translation.select("product_category_name", "product_category_name_english"),
        "product_category_name", "left",
    )
    return joined.select(
        "product_id",
        "product_category_name",
        category_or_unknown("product_category_name_english").alias("product_category_name_english"),
        *[
            text_to_decimal(c, SIZE_DECIMAL, mode).alias(c)
            for c in SIZES
        ],
    )


def build_dim_product(
    products: DataFrame, translation: DataFrame, mode: str = "strict", give_keys: GiveKeys = assign_keys
) -> DataFrame:
    """Products are not de-duplicated: repeated ids are for the key checks to report."""
    members = translated_products(products, translation, mode)
    return with_unknown(
        give_keys(members, "product_pk", unique=False),
        {
            "product_pk": UNKNOWN_KEY,
            "product_id": "-1",
            "product_category_name": "Unknown",
            "product_category_name_english": UNKNOWN_CATEGORY,
        },
    )


def build_dim_store(sellers: DataFrame, give_keys: GiveKeys = assign_keys) -> DataFrame:
    members = sellers.select(
        "seller_id",
        clean_city("seller_city").alias("store_city"),
        F.col("seller_state").alias("store_state"),
        F.col("seller_zip_code_prefix").alias("store_zip_code_prefix"),
    ).distinct()
    return with_unknown(
        give_keys(members, "store_pk"),
        {
            "store_pk": UNKNOWN_KEY,
            "seller_id": "-1",
            "store_city": "Unknown",
            "store_state": "Unknown",
            "store_zip_code_prefix": "Unknown",
        },
    )


def build_dim_month(dim_date: DataFrame) -> DataFrame:
    """Every calendar month of the date dimension, without the unknown date."""
    return (
        dim_date.where(F.col("date_id") != UNKNOWN_DATE_KEY)
        .select(
            dates.month_key("year", "month").alias("month_id"),
            F.trim("month_name").alias("month_name"),
            "quarter",
            "year",
        )
        .distinct()
    )


def narrow(dim: DataFrame, columns: list[str]) -> DataFrame:
    """Copy of a dimension with the attributes a mart needs; the key is reused."""
    return dim.select(*columns)
