"""Column contracts of the three layers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STAGING, CORE, MART = "staging", "core", "mart_finance"
LAYERS = (STAGING, CORE, MART)

# Raw column names, source misspellings included.
_RAW_COLUMNS = {
    "raw_orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "raw_order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "raw_order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "raw_order_reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "raw_products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "raw_product_category_translation": ["product_category_name", "product_category_name_english"],
    "raw_sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "raw_customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "raw_geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
}

RAW_SCHEMAS = {
    name: T.StructType([T.StructField(c, T.StringType()) for c in columns]) for name, columns in _RAW_COLUMNS.items()
}

# Free text that may hold line breaks; these files need the multi-line reader.
MULTILINE_TABLES = {"raw_order_reviews": ["review_comment_title", "review_comment_message"]}


@dataclass(frozen=True)
class Contract:
    """What a table must satisfy. Spark enforces none of it on a DataFrame; operators.validate does."""

    columns: dict[str, str]
    key: str
    natural_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, key)
    partition_by: str | None = None

    @property
    def decimals(self) -> dict[str, str]:
        return {c: t for c, t in self.columns.items() if t.startswith("decimal")}


_MONEY, _MART_MONEY, _SIZE = "decimal(10,2)", "decimal(12,2)", "decimal(18,4)"

CORE_CONTRACTS = {
    "dim_date": Contract(
        columns={
            "date_id": "int",
            "full_date": "date",
            "day": "int",
            "day_name": "string",
            "weekday_flag": "boolean",
            "month": "int",
            "month_name": "string",
            "quarter": "int",
            "year": "int",
            "is_holiday_flag": "boolean",
        },
        key="date_id",
        not_null=(
            "date_id",
            "full_date",
            "day",
            "day_name",
            "weekday_flag",
            "month",
            "month_name",
            "quarter",
            "year",
            "is_holiday_flag",
        ),
        max_length={"day_name": 10, "month_name": 10},
    ),
    "dim_customer": Contract(
        columns={
            "customer_pk": "bigint",
            "customer_id": "string",
            "customer_unique_id": "string",
            "customer_city": "string",
            "customer_state": "string",
            "customer_zip_code_prefix": "string",
        },
        key="customer_pk",
        natural_key=("customer_id",),
        not_null=("customer_pk", "customer_id"),
        max_length={
            "customer_id": 64,
            "customer_unique_id": 64,
            "customer_city": 100,
            "customer_state": 10,
            "customer_zip_code_prefix": 10,
        },
    ),
    "dim_product": Contract(
        columns={
            "product_pk": "bigint",
            "product_id": "string",
            "product_category_name": "string",
            "product_category_name_english": "string",
            "product_weight_g": _SIZE,
            "product_length_cm": _SIZE,
            "product_height_cm": _SIZE,
            "product_width_cm": _SIZE,
        },
        key="product_pk",
        natural_key=("product_id",),
        not_null=("product_pk", "product_id"),
        max_length={
            "product_id": 64,
            "product_category_name": 100,
            "product_category_name_english": 100,
        },
    ),
    "dim_store": Contract(
        columns={
            "store_pk": "bigint",
            "seller_id": "string",
            "store_city": "string",
            "store_state": "string",
            "store_zip_code_prefix": "string",
        },
        key="store_pk",
        natural_key=("seller_id",),
        not_null=("store_pk", "seller_id"),
        max_length={
            "seller_id": 64,
            "store_city": 100,
            "store_state": 10,
            "store_zip_code_prefix": 10,
        },
    ),
    "fact_sales": Contract(
        columns={
            "sales_fact_pk": "bigint",
            "order_id": "string",
            "order_item_id": "int",
            "date_fk": "int",
            "customer_fk": "bigint",
            "product_fk": "bigint",
            "store_fk": "bigint",
            "channel": "string",
            "order_status": "string",
            "quantity": "int",
            "price": _MONEY,
            "freight_value": _MONEY,
            "sales_amount": _MONEY,
            "product_cost": _MONEY,
            "profit": _MONEY,
        },
        key="sales_fact_pk",
        not_null=(
            "sales_fact_pk",
            "order_id",
            "order_item_id",
            "date_fk",
            "customer_fk",
            "product_fk",
            "store_fk",
            "channel",
            "quantity",
            "price",
            "freight_value",
            "sales_amount",
            "product_cost",
            "profit",
        ),
        max_length={"order_id": 64, "channel": 20, "order_status": 30},
        foreign_keys={
            "date_fk": ("dim_date", "date_id"),
            "customer_fk": ("dim_customer", "customer_pk"),
            "product_fk": ("dim_product", "product_pk"),
            "store_fk": ("dim_store", "store_pk"),
        },
        partition_by="sale_month",
    ),
}

MART_CONTRACTS = {
    "dim_month": Contract(
        columns={"month_id": "int", "month_name": "string", "quarter": "int", "year": "int"},
        key="month_id",
        not_null=("month_id",),
        max_length={"month_name": 10},
    ),
    "dim_product": Contract(
        columns={"product_pk": "bigint", "product_category_name_english": "string"},
        key="product_pk",
        not_null=("product_pk",),
        max_length={"product_category_name_english": 100},
    ),
    "dim_store": Contract(
        columns={"store_pk": "bigint", "store_city": "string", "store_state": "string"},
        key="store_pk",
        not_null=("store_pk",),
        max_length={"store_city": 100, "store_state": 10},
    ),
    "fact_revenue_by_month": Contract(
        columns={
            "revenue_fact_pk": "bigint",
            "month_fk": "int",
            "product_fk": "bigint",
            "store_fk": "bigint",
            "quantity": "int",
            "revenue": _MART_MONEY,
            "cost": _MART_MONEY,
            "profit": _MART_MONEY,
        },
        key="revenue_fact_pk",
        natural_key=("month_fk", "product_fk", "store_fk"),
        not_null=(
            "revenue_fact_pk",
            "month_fk",
            "product_fk",
            "store_fk",
            "quantity",
            "revenue",
            "cost",
            "profit",
        ),
        foreign_keys={
            "month_fk": ("dim_month", "month_id"),
            "product_fk": ("dim_product", "product_pk"),
            "store_fk": ("dim_store", "store_pk"),
        },
        partition_by="month_fk",
    ),
    "order_fulfilment_snapshot": Contract(
        columns={
            "fulfilment_fact_pk": "bigint",
            "order_id": "string",
            "customer_fk": "bigint",
            "order_date_fk": "int",
            "approved_date_fk": "int",
            "shipped_date_fk": "int",
            "delivered_date_fk": "int",
            "order_status": "string",
            "days_to_approve": "int",
            "days_to_ship": "int",
            "days_to_deliver": "int",
        },
        key="fulfilment_fact_pk",
        natural_key=("order_id",),
        not_null=(
            "fulfilment_fact_pk",
            "order_id",
            "customer_fk",
            "order_date_fk",
            "approved_date_fk",
            "shipped_date_fk",
            "delivered_date_fk",
        ),
        max_length={"order_id": 50, "order_status": 30},
        # Declared as plain columns in the mart; checked against core like the sales fact.
        foreign_keys={
            "customer_fk": ("dim_customer", "customer_pk"),
            "order_date_fk": ("dim_date", "date_id"),
            "approved_date_fk": ("dim_date", "date_id"),
            "shipped_date_fk": ("dim_date", "date_id"),
            "delivered_date_fk": ("dim_date", "date_id"),
        },
    ),
}

CONTRACTS = {CORE: CORE_CONTRACTS, MART: MART_CONTRACTS}
