"""Registered queries: one per operator, over the warehouse of one folder of test tables.

A query for a table runs that table's plan; profiling, checks and reports read published tables.
Dates are shown as text and sums as decimal(38,2), so that another engine compares alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import clean, dates
from tallyhouse.operators import audit, repeats
from tallyhouse.operators import profile as prof
from tallyhouse.operators import validate as val
from tallyhouse.operators.keys import assign_keys, insert_if_absent
from tallyhouse.plans import dims, extensions as ext, facts, rejects, reports
from tallyhouse.plans.warehouse import Warehouse, open_warehouse
from tallyhouse.sources import raw as rawio
from tallyhouse.sources.keymap import KeyMap
from tallyhouse.sources.layers import database, layer_names, layer_tables, work_path
from tallyhouse.sources.schemas import CONTRACTS, CORE, MART, MART_CONTRACTS, MULTILINE_TABLES, RAW_SCHEMAS, STAGING
from tallyhouse.sources.testdata import TestTables
from tallyhouse.streaming import fulfilment

Plan = Callable[[Warehouse, TestTables], DataFrame]
_PLANS: dict[str, Plan] = {}


def _query(plan: Plan) -> Plan:
    _PLANS[plan.__name__] = plan
    return plan


def _run(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plan(*open_warehouse(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(plan) for name, plan in _PLANS.items()}


def _wide(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(38,2)") for c in columns})


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _scratch(w: Warehouse, name: str) -> str:
    return work_path(w.spark, f"{name}-{uuid.uuid4().hex}")


# --- sources, sinks, catalog -------------------------------------------------------------------


@_query
def csv_load_counts(w, t):
    """Raw tables written as CSV and landed again."""
    loaded = {}
    for name in RAW_SCHEMAS:
        path = _scratch(w, name)
        rawio.write_raw(w.staging(name), path, gzip=name not in MULTILINE_TABLES)
        loaded[name] = rawio.load_raw(w.spark, name, path)
    return prof.row_counts(loaded)


@_query
def csv_reviews_roundtrip(w, t):
    """Reviews with line breaks and quotes inside fields, through CSV and back."""
    path = _scratch(w, "reviews")
    rawio.write_raw(w.staging("raw_order_reviews"), path)
    return rawio.load_raw(w.spark, "raw_order_reviews", path).select(
        "review_id", "order_id", "review_comment_title", F.md5("review_comment_message").alias("message_md5")
    )


@_query
def csv_blank_fields(w, t):
    """Blank fields stay blank strings through CSV."""
    path = _scratch(w, "orders")
    rawio.write_raw(w.staging("raw_orders"), path)
    back = rawio.load_raw(w.spark, "raw_orders", path)
    return back.agg(
        F.count_if(F.col("order_approved_at") == "").alias("empty_approved_at"),
        F.count_if(F.col("order_approved_at").isNull()).alias("null_approved_at"),
    )


@_query
def flatten_newlines(w, t):
    return rawio.flatten_newlines(t.source("documents").select("doc_id", "text"), ["text"])


@_query
def insert_if_absent_customers(w, t):
    """Seed two members: one is there already, one is not."""
    members = w.staging("raw_customers").select("customer_id", "customer_state")
    seeds = [{"customer_id": "0", "customer_state": "SEED"}, {"customer_id": "UNKNOWN", "customer_state": "Unknown"}]
    return insert_if_absent(members, seeds, "customer_id")


def _counted(w: Warehouse, layer: str) -> DataFrame:
    """Tables of a layer as the catalog lists them, with their rows."""
    names = [r["table_name"] for r in layer_tables(w.spark, layer, w.prefix).collect()]
    read = {STAGING: w.staging, CORE: w.core, MART: w.mart}[layer]
    return prof.row_counts({name: read(name) for name in names}).withColumnRenamed("tbl", "table_name")


@_query
def list_layers(w, t):
    """Layers that exist, with their tables and rows."""
    for layer in (STAGING, CORE, MART):
        _load_missing(w, layer)
    names = {r["schema_name"] for r in layer_names(w.spark, w.prefix).collect()}
    return prof.union_all(
        [
            _counted(w, layer)
            .agg(F.count(F.lit(1)).alias("tables"), F.sum("n").alias("n"))
            .select(F.lit(layer).alias("schema_name"), "tables", "n")
            for layer in (STAGING, CORE, MART)
            if database(layer, w.prefix) in names
        ]
    )


def _load_missing(w: Warehouse, layer: str) -> None:
    for name in RAW_SCHEMAS if layer == STAGING else CONTRACTS[layer]:
        {STAGING: w.staging, CORE: w.core, MART: w.mart}[layer](name)


@_query
def list_core_tables(w, t):
    _load_missing(w, CORE)
    return _counted(w, CORE)


@_query
def list_staging_tables(w, t):
    _load_missing(w, STAGING)
    return _counted(w, STAGING)


@_query
def peek_orders(w, t):
    return rawio.peek(w.staging("raw_orders"), 20)


# --- load verification and profiling -----------------------------------------------------------


@_query
def load_row_counts(w, t):
    return prof.row_counts({name: w.staging(name) for name in RAW_SCHEMAS})


@_query
def dup_orders(w, t):
    return repeats.duplicate_rows(w.staging("raw_orders"), ["order_id"])


@_query
def dup_customers(w, t):
    return repeats.duplicate_rows(w.staging("raw_customers"), ["customer_id"])


@_query
def dup_products(w, t):
    return repeats.duplicate_rows(w.staging("raw_products"), ["product_id"])


@_query
def dup_order_lines(w, t):
    return repeats.duplicate_rows(w.staging("raw_order_items"), ["order_id", "order_item_id"])


@_query
def dup_reviews_per_order(w, t):
    return repeats.duplicate_rows(w.staging("raw_order_reviews"), ["order_id"])


@_query
def dup_review_rows(w, t):
    """Whole-row copies; the message is shown as its digest."""
    reviews = w.staging("raw_order_reviews")
    return repeats.duplicate_rows(reviews, reviews.columns).withColumn(
        "review_comment_message", F.md5("review_comment_message")
    )


_ORDER_NULLS = {
    "order_id": "order_id",
    "customer_id": "customer_id",
    "order_status": "status",
    "order_purchase_timestamp": "purchase_ts",
    "order_approved_at": "approved_at",
    "order_delivered_carrier_date": "carrier_date",
    "order_delivered_customer_date": "delivered_date",
    "order_estimated_delivery_date": "estimated_date",
}
_PRODUCT_NULLS = {
    "product_category_name": "category",
    "product_weight_g": "weight",
    "product_length_cm": "length",
    "product_height_cm": "height",
    "product_width_cm": "width",
}


@_query
def null_profile_orders(w, t):
    return prof.null_profile(w.staging("raw_orders"), _ORDER_NULLS)


@_query
def null_profile_items(w, t):
    return prof.null_profile(
        w.staging("raw_order_items"),
        {"product_id": "product_id", "seller_id": "seller_id", "price": "price", "freight_value": "freight"},
    )


@_query
def null_profile_products(w, t):
    return prof.null_profile(w.staging("raw_products"), _PRODUCT_NULLS)


@_query
def null_profile_customers(w, t):
    return prof.null_profile(
        w.staging("raw_customers"),
        {"customer_city": "city", "customer_state": "state", "customer_zip_code_prefix": "zip"},
    )


@_query
def null_profile_blanked_orders(w, t):
    """The same profile once blanks are NULLs."""
    orders = w.staging("raw_orders")
    return prof.null_profile(orders.select(*[clean.blank_to_null(c).alias(c) for c in orders.columns]), _ORDER_NULLS)


@_query
def blank_profile_orders(w, t):
    return prof.blank_profile(
        w.staging("raw_orders"),
        {
            "order_approved_at": "approved_at",
            "order_delivered_carrier_date": "carrier_date",
            "order_delivered_customer_date": "delivered_date",
        },
    )


@_query
def blank_profile_items(w, t):
    return prof.blank_profile(w.staging("raw_order_items"), {"price": "price", "freight_value": "freight"})


@_query
def blank_profile_products(w, t):
    return prof.blank_profile(
        w.staging("raw_products"), {"product_category_name": "category", "product_weight_g": "weight"}
    )


@_query
def orphan_products(w, t):
    return prof.orphans(w.staging("raw_order_items"), w.staging("raw_products"), "product_id")


@_query
def orphan_sellers(w, t):
    return prof.orphans(w.staging("raw_order_items"), w.staging("raw_sellers"), "seller_id")


@_query
def orphan_customers(w, t):
    return prof.orphans(w.staging("raw_orders"), w.staging("raw_customers"), "customer_id")


@_query
def orphan_categories(w, t):
    return prof.orphans(
        w.staging("raw_products"), w.staging("raw_product_category_translation"), "product_category_name"
    )


@_query
def orphan_orders(w, t):
    """Order lines whose order is missing, which the sales fact leaves out."""
    return prof.orphans(w.staging("raw_order_items"), w.staging("raw_orders"), "order_id")


@_query
def orphan_order_keys_without_lines(w, t):
    """The opposite direction: orders without lines."""
    return prof.orphans(w.staging("raw_orders"), w.staging("raw_order_items"), "order_id")


@_query
def city_casing(w, t):
    return prof.casing_issues(w.staging("raw_customers"), "customer_city", 20)


@_query
def city_whitespace(w, t):
    return prof.whitespace_issues(w.staging("raw_customers"), "customer_city")


@_query
def price_format(w, t):
    return prof.pattern_violations(w.staging("raw_order_items"), "price", clean.NUMBER_PATTERN)


@_query
def payment_value_format(w, t):
    return prof.pattern_violations(w.staging("raw_order_payments"), "payment_value", clean.NUMBER_PATTERN)


@_query
def status_counts(w, t):
    return prof.value_counts(w.staging("raw_orders"), "order_status")


@_query
def timestamp_format(w, t):
    return prof.pattern_violations(w.staging("raw_orders"), "order_purchase_timestamp", clean.TIMESTAMP_PATTERN)


@_query
def shipping_limit_format(w, t):
    return prof.pattern_violations(w.staging("raw_order_items"), "shipping_limit_date", clean.TIMESTAMP_PATTERN)


@_query
def quality_report(w, t):
    """The issue register: every check with its class, its fix and the rows it concerns."""
    names = ["raw_orders", "raw_order_items", "raw_products", "raw_customers", "raw_sellers", "raw_product_category_translation"]
    city = F.col("customer_city")
    to_null, unknown = "blank to NULL, then type", "unknown member -1"

    def blank(table: str, issue: str, column: str, kind: str, fix: str) -> audit.Check:
        return audit.Check(table, issue, column, kind, fix, F.col(column) == "")

    def misfit(table: str, issue: str, column: str, fix: str, pattern: str) -> audit.Check:
        return audit.Check(table, issue, column, prof.FORMAT, fix, prof.violates(column, pattern))

    def orphan(table: str, column: str, parent: str, fix: str, issue: str = "orphan") -> audit.Reference:
        return audit.Reference(table, issue, column, prof.FOREIGN_KEY, fix, parent)

    def unique(table: str, key: tuple[str, ...], fix: str) -> audit.Unique:
        return audit.Unique(table, "duplicate key", ",".join(key), prof.FORMAT, fix, key)

    uneven = (city != clean.title_case(city)) & (city != F.upper(city))
    issues = [blank("raw_orders", "blank date", c, prof.FORMAT, to_null) for c in dims.MILESTONES.values()]
    issues += [misfit("raw_orders", "bad timestamp", c, "reject", clean.TIMESTAMP_PATTERN) for c in dims.MILESTONES.values()]
    issues += [blank("raw_products", "blank size", c, prof.MEASURE, to_null) for c in list(_PRODUCT_NULLS)[1:]]
    issues += [
        blank("raw_order_items", "blank amount", "price", prof.MEASURE, "reject"),
        blank("raw_order_items", "blank amount", "freight_value", prof.MEASURE, "default 0"),
        misfit("raw_order_items", "bad number", "price", "reject", clean.NUMBER_PATTERN),
        misfit("raw_order_items", "bad timestamp", "shipping_limit_date", "not loaded", clean.TIMESTAMP_PATTERN),
        audit.Check("raw_customers", "raw casing", "customer_city", prof.FORMAT, "title case", uneven),
        audit.Check("raw_customers", "edge spaces", "customer_city", prof.FORMAT, "trim", city != F.trim(city)),
        orphan("raw_order_items", "product_id", "raw_products", unknown),
        orphan("raw_order_items", "seller_id", "raw_sellers", unknown),
        orphan("raw_order_items", "order_id", "raw_orders", "left out"),
        orphan("raw_orders", "customer_id", "raw_customers", unknown),
        orphan("raw_products", "product_category_name", "raw_product_category_translation", clean.UNKNOWN_CATEGORY, "untranslated"),
        unique("raw_orders", ("order_id",), "report"),
        unique("raw_order_items", ("order_id", "order_item_id"), "keep, own row id"),
    ]
    found = audit.issue_counts({name: w.staging(name) for name in names}, issues)
    return found.orderBy("table_name", "column_name", "issue")


# --- cleaning and typing -----------------------------------------------------------------------


@_query
def typed_prices(w, t):
    items = w.staging("raw_order_items")
    return items.select(
        "order_id",
        clean.text_to_int("order_item_id").alias("order_item_id"),
        clean.text_to_decimal("price", "decimal(10,2)").alias("price"),
        clean.text_to_decimal("freight_value", "decimal(10,2)").alias("freight_value"),
    )


@_query
def order_date_keys(w, t):
    return w.staging("raw_orders").select(
        "order_id", *[facts.milestone_key(c).alias(f"{name}_key") for name, c in dims.MILESTONES.items()]
    )


@_query
def clean_city(w, t):
    return w.staging("raw_customers").select("customer_id", clean.clean_city("customer_city").alias("customer_city"))


@_query
def product_category_resolved(w, t):
    return dims.translated_products(w.staging("raw_products"), w.staging("raw_product_category_translation")).select(
        "product_id", "product_category_name", "product_category_name_english"
    )


@_query
def freight_default(w, t):
    lines = facts.line_measures(w.staging("raw_order_items").select("order_id", "price", "freight_value"))
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("freight_value") == 0).alias("zero_freight"),
        F.sum("freight_value").cast("decimal(38,2)").alias("freight_value"),
    )


@_query
def dummy_key_counts(w, t):
    fact = w.core("fact_sales")
    return fact.agg(
        F.count_if(F.col("date_fk") == clean.UNKNOWN_DATE_KEY).alias("unknown_date"),
        *[F.count_if(F.col(f"{d}_fk") == clean.UNKNOWN_KEY).alias(f"unknown_{d}") for d in ("customer", "product", "store")],
    )


@_query
def line_profit(w, t):
    lines = w.staging("raw_order_items").select("order_id", "order_item_id", "price", "freight_value")
    return facts.line_measures(lines).select("order_id", "order_item_id", "price", "product_cost", "profit")


@_query
def rounding_gap(w, t):
    """Lines whose cost and profit, rounded apart, do not add up to the price."""
    gap = F.col("product_cost") + F.col("profit") - F.col("sales_amount")
    return w.core("fact_sales").agg(
        F.count_if(gap != 0).alias("lines_off"), F.sum(gap).cast("decimal(38,2)").alias("total_gap")
    )


@_query
def cost_ratio_half(w, t):
    """Cost at another ratio than the default."""
    lines = facts.line_measures(
        w.staging("raw_order_items").select("order_id", "price", "freight_value"), cost_ratio=Decimal("0.5")
    )
    return _wide(lines.agg(F.sum("product_cost").alias("cost"), F.sum("profit").alias("profit")), "cost", "profit")


@_query
def price_rejects(w, t):
    """Quarantine: prices blanked and spoiled by a rule on the key, split from the good lines."""
    items = w.staging("raw_order_items")
    order = F.col("order_id").cast("long")
    spoiled = items.withColumn(
        "price",
        F.when(order % 131 == 0, "").when(order % 137 == 0, F.concat(F.lit("R$"), "price")).otherwise(F.col("price")),
    )
    good, bad = facts.split_rejects(spoiled)
    loaded = facts.line_measures(good).agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(38,2)").alias("price"))
    return (
        loaded.select(F.lit("loaded").alias("outcome"), "n", "price")
        .unionByName(
            bad.groupBy(F.col("reject_reason").alias("outcome")).agg(
                F.count(F.lit(1)).alias("n"), F.lit(None).cast("decimal(38,2)").alias("price")
            )
        )
    )


def _routed(w: Warehouse, name: str, key: str, spoil: dict[str, tuple[int, str]]) -> DataFrame:
    """Outcomes of a raw table of which some rows are spoiled by a rule on the key."""
    number = F.col(key).try_cast("long")
    spoiled = w.staging(name).withColumns({c: F.when(number % n == 0, bad).otherwise(F.col(c)) for c, (n, bad) in spoil.items()})
    return rejects.outcomes(rejects.route(w.spark, spoiled, rejects.REASONS[name](), _scratch(w, "routed")))


@_query
def order_rejects(w, t):
    """A day that no calendar has, and text behind a date."""
    bad = {"order_purchase_timestamp": (127, "2017-02-30 10:00:00"), "order_approved_at": (131, "2017-02-03 x")}
    return _routed(w, "raw_orders", "order_id", bad)


@_query
def product_rejects(w, t):
    """A weight that is no number, and a length of more digits than are kept."""
    return _routed(w, "raw_products", "product_id", {"product_weight_g": (13, "heavy"), "product_length_cm": (17, "1.23456")})


@_query
def fulfilment_lags(w, t):
    resolved = facts.resolve_orders(w.staging("raw_orders"), w.core("dim_customer"))
    return facts.build_fulfilment(resolved).select("order_id", "days_to_approve", "days_to_ship", "days_to_deliver")


@_query
def month_start(w, t):
    return _text(w.mart("dim_month").select("month_id", dates.month_start("month_id").alias("month_start_date")), "month_start_date")


# --- keys and dimensions -----------------------------------------------------------------------


@_query
def surrogate_keys(w, t):
    members = w.staging("raw_customers").select("customer_id")
    return assign_keys(members, "customer_pk")


@_query
def surrogate_keys_with_copies(w, t):
    """Rows that repeat get a key each, counted instead of sorted."""
    lines = w.staging("raw_order_items").select("order_id", "order_item_id")
    return assign_keys(lines, "line_pk", unique=False)


def _loaded_in_two(w: Warehouse, name: str) -> DataFrame:
    """Customers as a first load with those that have ordered, and a second one with all."""
    members = w.staging("raw_customers").select("customer_id")
    buyers = w.staging("raw_orders").select("customer_id").distinct()
    keys = KeyMap(w.spark, _scratch(w, name))
    keys.keyed(members.join(buyers, "customer_id", "left_semi"), "customer_pk", unique=False)
    return keys.keyed(members, "customer_pk", unique=False)


@_query
def keys_after_new_members(w, t):
    """Old members keep their keys, new ones follow."""
    return _loaded_in_two(w, "keys")


@_query
def monthly_fact_keys(w, t):
    """Keys of the monthly fact that a rebuild repeats."""
    grain = ["month_fk", "product_fk", "store_fk"]
    return assign_keys(w.mart("fact_revenue_by_month").select(*grain), "revenue_fact_pk")


@_query
def unknown_members(w, t):
    rows = [
        w.core(table)
        .where(F.col(pk) == clean.UNKNOWN_KEY)
        .select(F.lit(table).alias("table_name"), F.col(pk).alias("pk"), F.col(nk).alias("natural_key"), F.col(label).alias("label"))
        for table, pk, nk, label in (
            ("dim_customer", "customer_pk", "customer_id", "customer_city"),
            ("dim_product", "product_pk", "product_id", "product_category_name_english"),
            ("dim_store", "store_pk", "seller_id", "store_city"),
        )
    ]
    day = w.core("dim_date").where(F.col("date_id") == clean.UNKNOWN_DATE_KEY)
    rows.append(
        day.select(
            F.lit("dim_date").alias("table_name"),
            F.col("date_id").cast("long").alias("pk"),
            F.col("full_date").cast("string").alias("natural_key"),
            F.col("day_name").alias("label"),
        )
    )
    return prof.union_all(rows)


@_query
def dim_date(w, t):
    return _text(w.build(CORE, "dim_date"), "full_date")


@_query
def dim_date_fixed_range(w, t):
    """Calendar of a given range, with the days without any order marked as holidays."""
    orders = w.staging("raw_orders").select(clean.text_to_date("order_purchase_timestamp").alias("full_date"))
    busy = orders.where(F.col("full_date").isNotNull()).distinct()
    bounds = dims.fixed_bounds(w.spark, "2000-06-01", "2002-05-31")
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("full_date"))
    return _text(dims.build_dim_date(bounds, days.join(busy, "full_date", "left_anti")), "full_date")


@_query
def dim_customer(w, t):
    return w.build(CORE, "dim_customer")


@_query
def dim_product(w, t):
    return w.build(CORE, "dim_product")


@_query
def dim_store(w, t):
    return w.build(CORE, "dim_store")


@_query
def dim_month(w, t):
    return w.build(MART, "dim_month")


@_query
def mart_dim_product(w, t):
    return w.build(MART, "dim_product")


@_query
def mart_dim_store(w, t):
    return w.build(MART, "dim_store")


# --- facts -------------------------------------------------------------------------------------


@_query
def fact_sales(w, t):
    return w.build(CORE, "fact_sales")


@_query
def fact_revenue_by_month(w, t):
    return w.build(MART, "fact_revenue_by_month")


@_query
def order_fulfilment_snapshot(w, t):
    return w.build(MART, "order_fulfilment_snapshot")


@_query
def fulfilment_role_dates(w, t):
    rows = reports.fulfilment_role_dates(w.mart("order_fulfilment_snapshot"), w.core("dim_date"))
    shown = ["order_id"]
    for role in ("order", "approved", "shipped", "delivered"):
        shown += [f"{role}_date", f"{role}_day_name", f"{role}_weekday_flag"]
    return _text(rows.select(*shown), *[f"{r}_date" for r in ("order", "approved", "shipped", "delivered")])


# --- reports -----------------------------------------------------------------------------------


def _monthly(w: Warehouse) -> DataFrame:
    return w.mart("fact_revenue_by_month")


@_query
def finance_dataset(w, t):
    rows = reports.finance_dataset(_monthly(w), w.mart("dim_month"), w.mart("dim_product"), w.mart("dim_store"))
    return _text(rows, "month_start_date")


@_query
def monthly_trend(w, t):
    return _wide(reports.monthly_trend(_monthly(w)), "revenue", "profit")


@_query
def profit_margin(w, t):
    return reports.profit_margin(_monthly(w))


@_query
def profit_margin_by_month(w, t):
    return reports.profit_margin_by_month(_monthly(w))


@_query
def revenue_by_category(w, t):
    return _wide(reports.revenue_by_category(_monthly(w), w.mart("dim_product")), "revenue")


@_query
def profit_by_category(w, t):
    return _wide(reports.profit_by_category(_monthly(w), w.mart("dim_product")), "profit")


@_query
def unit_price_by_category(w, t):
    return reports.unit_price_by_category(_monthly(w), w.mart("dim_product"))


@_query
def revenue_by_city(w, t):
    return _wide(reports.revenue_by_city(_monthly(w), w.mart("dim_store")), "revenue")


@_query
def avg_days_to_deliver(w, t):
    return reports.avg_days_to_deliver(w.mart("order_fulfilment_snapshot"))


@_query
def fulfilment_stage_averages(w, t):
    return reports.fulfilment_stage_averages(w.mart("order_fulfilment_snapshot"))


@_query
def ytd_revenue(w, t):
    return _text(_wide(reports.ytd_revenue(_monthly(w), w.mart("dim_month")), "revenue"), "month_start_date")


# --- validation and reconciliation -------------------------------------------------------------


@_query
def fk_validation(w, t):
    return val.fk_validation(
        w.core("fact_sales"),
        {
            "customer": (w.core("dim_customer"), "customer_fk", "customer_pk"),
            "product": (w.core("dim_product"), "product_fk", "product_pk"),
            "store": (w.core("dim_store"), "store_fk", "store_pk"),
            "date": (w.core("dim_date"), "date_fk", "date_id"),
        },
    )


@_query
def mart_row_counts(w, t):
    return prof.row_counts({name: w.mart(name) for name in MART_CONTRACTS})


@_query
def mart_reconciliation(w, t):
    return val.mart_reconciliation(_monthly(w), w.core("fact_sales"))


def _tables(w: Warehouse):
    for layer, contracts in CONTRACTS.items():
        for name, contract in contracts.items():
            yield f"{layer}.{name}", (w.core if layer == CORE else w.mart)(name), contract


@_query
def pk_violations(w, t):
    tables = [(name, df, [(contract.key,), *([contract.natural_key] if contract.natural_key else [])]) for name, df, contract in _tables(w)]
    # The line number is no key in the sales fact: its row id is.
    return repeats.key_violations([(name, df, keys + ([("order_id", "order_item_id")] if name == "core.fact_sales" else [])) for name, df, keys in tables])


@_query
def not_null_violations(w, t):
    return prof.union_all([val.not_null_violations(df, name, contract) for name, df, contract in _tables(w)])


@_query
def fk_violations(w, t):
    """All foreign keys of a table in one scan of it."""
    parts = [val.fk_violations_of(df, name, w.parents(name.split(".")[0], contract)) for name, df, contract in _tables(w) if contract.foreign_keys]
    return prof.union_all(parts)


@_query
def domain_violations(w, t):
    parts = [val.domain_violations(df, name, contract) for name, df, contract in _tables(w)]
    return prof.union_all([p for p in parts if p is not None])


# --- checks that must find something -----------------------------------------------------------


def _marked(key: str, n: int):
    """Rows that a fault is put into, by a rule on their key."""
    return F.coalesce(F.col(key).cast("long") % n == 0, F.lit(False))


def _repeated(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.unionByName(df.where(_marked(key, n)))


@_query
def dup_orders_injected(w, t):
    return prof.duplicate_keys(_repeated(w.staging("raw_orders"), "order_id", 101), ["order_id"])


@_query
def dup_customers_injected(w, t):
    return prof.duplicate_keys(_repeated(w.staging("raw_customers"), "customer_id", 7), ["customer_id"])


@_query
def dup_products_injected(w, t):
    return prof.duplicate_keys(_repeated(w.staging("raw_products"), "product_id", 11), ["product_id"])


@_query
def orphan_orders_injected(w, t):
    orders = w.staging("raw_orders").where(~_marked("order_id", 103))
    return prof.orphans(w.staging("raw_order_items"), orders, "order_id")


@_query
def price_format_injected(w, t):
    price = F.when(_marked("order_id", 107), F.concat(F.lit("R$"), "price")).otherwise(F.col("price"))
    return prof.pattern_violations(w.staging("raw_order_items").withColumn("price", price), "price", clean.NUMBER_PATTERN)


@_query
def timestamp_format_injected(w, t):
    column = "order_purchase_timestamp"
    spoiled = F.when(_marked("order_id", 109), F.substring(column, 1, 10)).otherwise(F.col(column))
    return prof.pattern_violations(w.staging("raw_orders").withColumn(column, spoiled), column, clean.TIMESTAMP_PATTERN)


@_query
def not_null_violations_injected(w, t):
    contract = CONTRACTS[CORE]["fact_sales"]
    gone = {c: F.when(~_marked("order_id", n), F.col(c)) for c, n in (("price", 13), ("store_fk", 17))}
    return val.not_null_violations(w.core("fact_sales").withColumns(gone), "core.fact_sales", contract).where("n > 0")


@_query
def fk_violations_injected(w, t):
    """A third of the stores, by their business key, is missing."""
    stores = w.core("dim_store")
    gone = stores.where(_marked("seller_id", 3)).select("store_pk")
    kept = stores.join(gone, "store_pk", "left_anti")
    return val.fk_violations(w.core("fact_sales"), "core.fact_sales", "store_fk", kept, "core.dim_store", "store_pk")


# --- beyond the scripts ------------------------------------------------------------------------


def _with_channel(w: Warehouse) -> DataFrame:
    return ext.assign_channel(w.core("fact_sales"))


@_query
def channel_assignment(w, t):
    return ext.assign_channel(w.staging("raw_orders").select("order_id"))


@_query
def channel_by_payment(w, t):
    return ext.channel_of_payments(w.staging("raw_order_payments"))


@_query
def mtd_revenue_by_channel(w, t):
    return ext.mtd_revenue_by_channel(_with_channel(w))


@_query
def yoy_growth_by_channel(w, t):
    return ext.yoy_growth_by_channel(_with_channel(w))


@_query
def avg_order_value_by_segment(w, t):
    return ext.avg_order_value_by_segment(w.core("fact_sales"), w.core("dim_customer"), t.segments())


@_query
def daily_channel_snapshot(w, t):
    return ext.daily_channel_snapshot(_with_channel(w), w.core("dim_date"))


@_query
def dim_product_category(w, t):
    return ext.build_dim_product_category(w.core("dim_product"))


@_query
def product_category_fk(w, t):
    product = w.core("dim_product")
    return ext.products_with_category(product, ext.build_dim_product_category(product)).select("product_id", "category_fk")


@_query
def profit_by_category_region(w, t):
    return _wide(
        reports.profit_by_category_region(_monthly(w), w.mart("dim_product"), w.mart("dim_store")), "profit"
    )


def _progress(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Raw orders as two batches: as placed and approved, then the rest with those two blanked."""
    orders = w.staging("raw_orders")
    placed, approved, shipped, delivered = dims.MILESTONES.values()
    first = orders.withColumns({shipped: F.lit(""), delivered: F.lit(""), "order_status": F.lit("processing")})
    second = orders.withColumns({placed: F.lit(""), approved: F.lit("")})
    return first, second


def _snapshot_keys(snapshot: DataFrame) -> DataFrame:
    return facts.build_fulfilment(snapshot.select("order_id", *dims.MILESTONES, "order_status"))


@_query
def fulfilment_upsert(w, t):
    first, second = (fulfilment.order_reports(batch) for batch in _progress(w))
    state = fulfilment.fulfilment_upsert(first, second)
    return _snapshot_keys(fulfilment.fulfilment_upsert(state, second))


@_query
def fulfilment_stream(w, t):
    """The same two batches as files, followed by a stream."""
    folder = _scratch(w, "stream")
    for batch in _progress(w):
        batch.write.mode("append").parquet(f"{folder}/orders")
        fulfilment.follow_orders(w.spark, f"{folder}/orders", f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return _snapshot_keys(fulfilment.read_state(w.spark, f"{folder}/state"))


@_query
def snapshot_after_merge(w, t):
    """The snapshot that two merged batches leave, with the customers' keys."""
    snapshot = fulfilment.FulfilmentSnapshot(w.spark, _scratch(w, "snapshot"))
    for number, batch in enumerate(_progress(w)):
        snapshot.merge(batch, w.core("dim_customer"), number)
    return snapshot.read()
