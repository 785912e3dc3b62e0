"""Adapter: the star-schema test tables in the shape of the nine raw tables.

The test data is clean, so some values are blanked, orphaned or misformatted by a rule on the
key. All columns come out as text, missing values as ``''``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.schemas import RAW_SCHEMAS


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _blank_if(condition: Column, value: Column) -> Column:
    return F.when(condition, F.lit("")).otherwise(value)


def _money(value: Column) -> Column:
    return value.cast("decimal(10,2)").cast("string")


def _at(day: Column, time: str) -> Column:
    return F.concat(F.to_date(day).cast("string"), F.lit(f" {time}"))


class TestTables:
    """Raw tables derived from the parquet files of one folder."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:  # the schema is read from a file footer: once is enough
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    def raw(self, name: str) -> DataFrame:
        builders: dict[str, Callable[[], DataFrame]] = {
            "raw_orders": self._orders,
            "raw_order_items": self._items,
            "raw_order_payments": self._payments,
            "raw_order_reviews": self._reviews,
            "raw_products": self._products,
            "raw_product_category_translation": self._translation,
            "raw_sellers": self._sellers,
            "raw_customers": self._customers,
            "raw_geolocation": self._geolocation,
        }
        return builders[name]().select(*RAW_SCHEMAS[name].fieldNames())

    def segments(self) -> DataFrame:
        """Customer segment by customer_id, which no raw table carries."""
        return self.source("customer").select(
            _text("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
        )

    def _places(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_name"
        )

    def _orders(self) -> DataFrame:
        shipped = (
            self.source("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min(F.to_date("l_shipdate")).alias("first_ship"), F.max(F.to_date("l_shipdate")).alias("last_ship"))
        )
        key, status, day = F.col("o_orderkey"), F.col("o_orderstatus"), F.to_date("o_orderdate")
        approved = F.date_add(day, (key % 4).cast("int"))
        return (
            self.source("orders")
            .join(shipped, "o_orderkey", "left")
            .select(
                _text("o_orderkey").alias("order_id"),
                F.when(key % 211 == 0, F.concat(F.lit("ghost-"), _text("o_custkey")))
                .otherwise(_text("o_custkey"))
                .alias("customer_id"),
                F.when(status == "F", "delivered")
                .when(status == "O", "shipped")
                .otherwise("processing")
                .alias("order_status"),
                _blank_if(key % 97 == 0, _at(day, "08:15:00")).alias("order_purchase_timestamp"),
                _blank_if(key % 89 == 0, _at(approved, "23:59:59")).alias("order_approved_at"),
                _blank_if((status == "P") | F.col("first_ship").isNull(), _at(F.col("first_ship"), "00:00:01")).alias(
                    "order_delivered_carrier_date"
                ),
                _blank_if((status != "F") | F.col("last_ship").isNull(), _at(F.col("last_ship"), "12:00:00")).alias(
                    "order_delivered_customer_date"
                ),
                _at(F.date_add(day, 21), "00:00:00").alias("order_estimated_delivery_date"),
            )
        )

    def _items(self) -> DataFrame:
        order, part = F.col("l_orderkey"), F.col("l_partkey")
        return self.source("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            _text("l_linenumber").alias("order_item_id"),
            F.when(part % 53 == 0, F.concat(F.lit("ghost-"), _text("l_partkey")))
            .otherwise(_text("l_partkey"))
            .alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            F.when(order % 83 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
            .otherwise(_at(F.col("l_shipdate"), "18:00:00"))
            .alias("shipping_limit_date"),
            _money(F.col("l_extendedprice")).alias("price"),
            _blank_if(F.col("l_tax") == 0, _money(F.col("l_tax") * 100)).alias("freight_value"),
        )

    def _payments(self) -> DataFrame:
        key, value = F.col("o_orderkey"), _money(F.col("o_totalprice"))
        return self.source("orders").select(
            _text("o_orderkey").alias("order_id"),
            F.lit("1").alias("payment_sequential"),
            F.when(key % 4 == 0, "card")
            .when(key % 4 == 1, "voucher")
            .when(key % 4 == 2, "transfer")
            .otherwise("wallet")
            .alias("payment_type"),
            (key % 6 + 1).cast("string").alias("payment_installments"),
            F.when(key % 307 == 0, F.concat(F.lit("USD "), value)).otherwise(value).alias("payment_value"),
        )

    def _reviews(self) -> DataFrame:
        doc = F.col("doc_id")
        copies = F.when(doc % 50 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        day = F.date_add(F.lit("2000-01-01").cast("date"), (doc % 365).cast("int"))
        return self.source("documents").select(
            _text("doc_id").alias("review_id"),
            F.floor(doc / 2).cast("string").alias("order_id"),
            (doc % 5 + 1).cast("string").alias("review_score"),
            F.concat(F.col("lang"), F.lit(', "'), F.col("source"), F.lit('"')).alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            _at(day, "00:00:00").alias("review_creation_date"),
            _at(day, "20:30:00").alias("review_answer_timestamp"),
            F.explode(copies).alias("copy"),
        )

    def _products(self) -> DataFrame:
        size = F.col("p_size")
        return self.source("part").select(
            _text("p_partkey").alias("product_id"),
            _blank_if(size == 50, F.lower("p_type")).alias("product_category_name"),
            F.length("p_name").cast("string").alias("product_name_lenght"),
            (F.length("p_name") * 10).cast("string").alias("product_description_lenght"),
            (size % 6).cast("string").alias("product_photos_qty"),
            _blank_if(size < 5, _text("p_size")).alias("product_weight_g"),
            (size + 10).cast("string").alias("product_length_cm"),
            (size + 2).cast("string").alias("product_height_cm"),
            _blank_if(size % 7 == 0, (size + 5).cast("string")).alias("product_width_cm"),
        )

    def _translation(self) -> DataFrame:
        return (
            self.source("part")
            .where(F.col("p_type") != "PROMO")
            .select(
                F.lower("p_type").alias("product_category_name"),
                F.concat("p_type", F.lit(" (en)")).alias("product_category_name_english"),
            )
            .distinct()
        )

    def _sellers(self) -> DataFrame:
        return (
            self.source("supplier")
            .where(F.col("s_suppkey") % 10 != 9)
            .join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                _text("s_suppkey").alias("seller_id"),
                F.lpad(_text("s_nationkey"), 5, "0").alias("seller_zip_code_prefix"),
                F.lower("n_name").alias("seller_city"),
                F.col("r_name").alias("seller_state"),
            )
        )

    def _customers(self) -> DataFrame:
        city = F.concat(F.lit(" "), F.lower("n_name"), F.lit("-"), F.lower("r_name"), F.lit(" "))
        return (
            self.source("customer")
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_unique_id"),
                F.lpad(_text("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
                city.alias("customer_city"),
                F.col("r_name").alias("customer_state"),
            )
        )

    def _geolocation(self) -> DataFrame:
        return (
            self.source("customer")
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.lpad(_text("c_nationkey"), 5, "0").alias("geolocation_zip_code_prefix"),
                (F.col("c_nationkey") - 30).cast("string").alias("geolocation_lat"),
                (F.col("c_nationkey") * 2 - 60).cast("string").alias("geolocation_lng"),
                F.lower("n_name").alias("geolocation_city"),
                F.col("r_name").alias("geolocation_state"),
            )
        )
