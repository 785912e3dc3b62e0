"""Facts: order lines, monthly revenue, order fulfilment."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import dates
from tallyhouse.functions.clean import (
    UNKNOWN_DATE_KEY,
    WIDE_DECIMAL,
    blank_to_null,
    date_key_or_unknown,
    key_or_unknown,
    required,
    text_to_date,
    text_to_decimal,
    text_to_int,
    within,
)
from tallyhouse.functions.measures import COST_RATIO, MONEY, MONTHLY_MONEY, estimated_cost, estimated_profit
from tallyhouse.operators.keys import Keep, assign_group_keys, assign_keys
from tallyhouse.operators.skew import hot_keys, skew_join
from tallyhouse.plans.dims import MILESTONES
from tallyhouse.session import fits_broadcast, shuffle_width


def milestone_key(column: str, mode: str = "strict") -> Column:
    return date_key_or_unknown(dates.date_key(text_to_date(column, mode)))


def typed_amounts(items: DataFrame) -> DataFrame:
    """Typed ``price`` and ``freight_value`` of order lines, and in ``_exact`` the price where its text has
    more digits than the column keeps. A blank price fails; a blank freight value means that none was
    charged."""
    wide = items.withColumn("_wide", required(text_to_decimal("price"), "price"))
    wide = wide.withColumn("price", within("_wide", MONEY))
    return wide.select(
        *[c for c in items.columns if c not in ("price", "freight_value")],
        "price",
        within(F.coalesce(text_to_decimal("freight_value"), F.lit(0)), MONEY).alias("freight_value"),
        F.when(F.col("_wide") != F.col("price"), F.col("_wide")).alias("_exact"),
    )


def derived_amounts(lines: DataFrame, cost_ratio: Decimal = COST_RATIO, quantity: int = 1) -> DataFrame:
    """Typed lines with amount, cost and profit of ``quantity`` pieces in place of ``_exact``."""
    exact = F.coalesce("_exact", F.col("price").cast(WIDE_DECIMAL))
    price = exact if quantity == 1 else exact * quantity
    return lines.select(
        *[c for c in lines.columns if c not in ("price", "freight_value", "_exact")],
        F.lit(quantity).alias("quantity"),
        "price",
        "freight_value",
        (F.col("price") if quantity == 1 else within(F.col("price") * quantity, MONEY)).alias("sales_amount"),
        estimated_cost(price, cost_ratio).cast(MONEY).alias("product_cost"),
        estimated_profit(price, cost_ratio).cast(MONEY).alias("profit"),
    )


def line_measures(items: DataFrame, cost_ratio: Decimal = COST_RATIO, quantity: int = 1) -> DataFrame:
    """Replace the raw amounts of order lines by typed, derived measures. A blank price fails;
    a blank freight value means that none was charged. ``price`` is that of one piece; amount, cost
    and profit are those of ``quantity`` pieces."""
    return derived_amounts(typed_amounts(items), cost_ratio, quantity)


def line_reject_reason() -> Column:
    """Why an order line would fail the load, NULL where it loads."""
    price = text_to_decimal("price", mode="lenient")
    freight = text_to_decimal("freight_value", mode="lenient")
    return (
        F.when(blank_to_null("price").isNull(), "blank price")
        .when(price.isNull() | price.try_cast(MONEY).isNull(), "bad price")
        .when(blank_to_null("freight_value").isNotNull() & freight.try_cast(MONEY).isNull(), "bad freight value")
        .when(text_to_int("order_item_id", mode="lenient").isNull(), "bad order item")
    )


def split_rejects(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantine mode: (lines that load, lines that would fail the load with the reason).

    The reason is the one element of an array: a filter on it stays above, where on a plain column it would
    be moved below whatever ``items`` computes, and repeat that for each mention of a price.
    """
    marked = items.select("*", F.explode(F.array(line_reject_reason())).alias("reject_reason"))
    good = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.where(F.col("reject_reason").isNotNull())


def resolve_orders(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders with typed milestones and the customer key: what both facts need of an order.

    Write it once and hand it to both, so that orders and customers, each as long as the order
    book, are parsed and joined once.
    """
    # Dates are a fifth as long as their texts: typed first, they pass the shuffle.
    typed = orders.select(
        "customer_id", "order_id", "order_status", *[text_to_date(column).alias(name) for name, column in MILESTONES.items()]
    )
    resolved = skew_join(
        typed,
        dim_customer.select("customer_id", F.col("customer_pk").alias("customer_fk")),
        "customer_id",
        "left",
        probe=orders,
    )
    return resolved.select(
        "order_id",
        key_or_unknown("customer_fk").alias("customer_fk"),
        *MILESTONES,
        "order_status",
    )


def build_fact_sales(
    items: DataFrame,
    resolved_orders: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    cost_ratio: Decimal = COST_RATIO,
    channel: str = "Website",
    quantity: int = 1,
    by_month: bool = False,
    keep: Keep | None = None,
) -> DataFrame:
    """One row per order line with an order; unmatched dimension keys become the unknown member.

    Customers come with the orders (``resolve_orders``): they are looked up on the shorter side. Lines get
    their keys before they meet the orders, and what follows from price or is constant after the last
    shuffle, so that what is moved stays narrow. ``by_month`` adds ``sale_month`` and rebalances by it.
    ``keep`` gets the lines when they were shuffled for stores, and when for orders, as the shuffles of all joins
    and of the rebalance would else be on disk together.
    """
    headers = resolved_orders.select(
        "order_id", "order_status", date_key_or_unknown(dates.date_key("order_date")).alias("date_fk"), "customer_fk"
    )
    lines = typed_amounts(
        items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    ).withColumn("order_item_id", required(text_to_int("order_item_id"), "order_item_id"))
    # Where an amount may be out of range though the price is not, lines without an order are checked too.
    early = quantity != 1 or not 0 <= cost_ratio <= 1
    if early:
        lines = derived_amounts(lines, cost_ratio, quantity)

    def kept(joined: DataFrame, side: DataFrame) -> DataFrame:
        return joined if keep is None or fits_broadcast(side) else keep(joined, "lines")

    stores = dim_store.select("seller_id", F.col("store_pk").alias("store_fk"))
    lines = kept(skew_join(lines, stores, "seller_id", "left", probe=items).drop("seller_id"), stores)
    products = dim_product.select("product_id", F.col("product_pk").alias("product_fk"))
    lines = skew_join(lines, products, "product_id", "left", probe=items).drop("product_id")
    lines = kept(skew_join(lines, headers, "order_id", "inner", probe=items, right_probe=resolved_orders), headers)
    if by_month:
        lines = lines.withColumn("sale_month", dates.month_of_date_key("date_fk")).hint("rebalance", F.col("sale_month"))
    if not early:
        lines = derived_amounts(lines, cost_ratio, quantity)
    return lines.select(
        "order_id",
        "order_item_id",
        "date_fk",
        "customer_fk",
        key_or_unknown("product_fk").alias("product_fk"),
        key_or_unknown("store_fk").alias("store_fk"),
        F.lit(channel).alias("channel"),
        "order_status",
        "quantity",
        "price",
        "freight_value",
        "sales_amount",
        "product_cost",
        "profit",
        *(["sale_month"] if by_month else []),
    )


_MONTHLY_GRAIN = ["month_fk", "product_fk", "store_fk"]


def _monthly_sums() -> dict[str, Column]:
    return {
        "quantity": within(F.sum("quantity"), "int"),
        "revenue": within(F.sum("sales_amount"), MONTHLY_MONEY),
        "cost": within(F.sum("product_cost"), MONTHLY_MONEY),
        "profit": within(F.sum("profit"), MONTHLY_MONEY),
    }


def _monthly_lines(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Lines with their month; those without a date are left out."""
    months = dim_date.select(F.col("date_id").alias("date_fk"), dates.month_key("year", "month").alias("month_fk"))
    dated = fact_sales.where(F.col("date_fk") != UNKNOWN_DATE_KEY)
    return skew_join(dated, months, "date_fk", "inner").select(
        *_MONTHLY_GRAIN, "quantity", "sales_amount", "product_cost", "profit"
    )


def _summed(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_MONTHLY_GRAIN).agg(*[s.alias(c) for c, s in _monthly_sums().items()])


def build_monthly(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Additive measures by product, store and month; lines without a date are left out."""
    return _summed(_monthly_lines(fact_sales, dim_date))


def summing_pays(lines: DataFrame) -> bool:
    """Whether lines become much fewer when tasks sum them before they are shuffled, or one group holds more
    than a shuffle partition's share of them."""
    groups = lines.select(F.xxhash64(*_MONTHLY_GRAIN).alias("g"))
    rows, different = groups.agg(F.count(F.lit(1)), F.approx_count_distinct("g")).first()
    return 2 * different <= rows or any(hot_keys([groups], "g", max(2, shuffle_width(lines.sparkSession))))


def build_keyed_monthly(fact_sales: DataFrame, dim_date: DataFrame, key: str, keep: Keep) -> DataFrame:
    """``build_monthly`` with repeatable keys (``assign_keys``), in parts that are written by ``keep``. Where few
    lines share a group they are shuffled once for both."""
    lines = _monthly_lines(fact_sales, dim_date)
    if summing_pays(lines):
        return assign_keys(keep(_summed(lines), "summed"), key, _MONTHLY_GRAIN, keep=keep)
    return assign_group_keys(lines, key, _MONTHLY_GRAIN, _monthly_sums(), keep)


def build_fulfilment(resolved_orders: DataFrame) -> DataFrame:
    """One row per order: four milestone keys and the calendar days between them.

    ``days_to_deliver`` runs from carrier to customer. Lags are neither clamped nor defaulted.
    """
    others = [c for c in resolved_orders.columns if c not in MILESTONES and c != "order_status"]
    return resolved_orders.select(
        *others,
        *[date_key_or_unknown(dates.date_key(name)).alias(f"{name}_fk") for name in MILESTONES],
        "order_status",
        dates.days_between("approved_date", "order_date").alias("days_to_approve"),
        dates.days_between("shipped_date", "approved_date").alias("days_to_ship"),
        dates.days_between("delivered_date", "shipped_date").alias("days_to_deliver"),
    )
