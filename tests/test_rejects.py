"""Rows that would fail a load: routed aside, counted, and left out by a warehouse in quarantine mode."""

import uuid

import pytest
from pyspark.errors import PySparkException

from tallyhouse.functions import clean
from tallyhouse.plans import extensions, rejects
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import work_root
from tallyhouse.sources.layers import work_path
from tallyhouse.sources.schemas import CORE, RAW_SCHEMAS


def table(spark, name, *rows):
    columns = RAW_SCHEMAS[name].fieldNames()
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows], RAW_SCHEMAS[name])


def raw(spark):
    day = "2020-01-0{} 10:00:00"
    return {
        "raw_orders": table(
            spark, "raw_orders",
            {"order_id": "o1", "customer_id": "c1", "order_status": "delivered", "order_purchase_timestamp": day.format(1)},
            {"order_id": "o2", "customer_id": "c1", "order_status": "created", "order_purchase_timestamp": "2020-02-30 10:00:00"},
            {"order_id": "", "customer_id": "c1", "order_status": "created", "order_purchase_timestamp": day.format(2)},
            {"order_id": "o3", "customer_id": "c1", "order_status": "created", "order_purchase_timestamp": day.format(3), "order_delivered_customer_date": "soon"},
        ),
        "raw_products": table(
            spark, "raw_products",
            {"product_id": "p1", "product_weight_g": "12.5"},
            {"product_id": "p2", "product_weight_g": "12.34567"},
            {"product_id": "p3", "product_width_cm": "wide"},
        ),
        "raw_order_items": table(
            spark, "raw_order_items",
            {"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "price": "10.00", "freight_value": ""},
            {"order_id": "o1", "order_item_id": "2", "product_id": "p2", "seller_id": "s1", "price": "", "freight_value": ""},
            {"order_id": "o1", "order_item_id": "3", "product_id": "p2", "seller_id": "s1", "price": "5.00", "freight_value": ""},
        ),
        "raw_customers": table(spark, "raw_customers", {"customer_id": "c1"}),
        "raw_sellers": table(spark, "raw_sellers", {"seller_id": "s1"}),
    }


def warehouse(spark, **options):
    tables = raw(spark)
    name = uuid.uuid4().hex[:8]
    return Warehouse(
        spark, lambda n: tables[n] if n in tables else table(spark, n), prefix=f"q{name}_", root=f"{work_root(spark)}/{name}", **options
    )


def test_a_warehouse_in_quarantine_loads_the_rest(spark):
    w = warehouse(spark, quarantine=True)
    sales = w.load(CORE, "fact_sales")
    assert sorted((r.order_item_id, r.product_fk) for r in sales.collect()) == [(1, 1), (3, -1)]
    orders, products, lines = (w.routed(n) for n in ("raw_orders", "raw_products", "raw_order_items"))
    assert (orders.rows_read, orders.rows_loaded, orders.rows_rejected) == (4, 1, 3)
    assert {r.order_id: r.reject_reason for r in orders.rejects.collect()} == {"o2": "bad order_date", "": "blank order_id", "o3": "bad delivered_date"}
    assert {r.product_id: r.reject_reason for r in products.rejects.collect()} == {"p2": "bad product_weight_g", "p3": "bad product_width_cm"}
    assert [r.reject_reason for r in lines.rejects.collect()] == ["blank price"]
    assert {r.outcome: r.n for r in rejects.outcomes(lines).collect()} == {"loaded": 2, "blank price": 1}


def test_without_quarantine_such_rows_fail_the_load(spark):
    w = warehouse(spark)
    with pytest.raises(PySparkException, match="not a number of at most 4 decimals"):
        w.load(CORE, "dim_product")


@pytest.mark.parametrize("keep", [True, False])
def test_tables_all_of_one_outcome(spark, keep):
    rows = raw(spark)["raw_products"].where("product_id = 'p1'" if keep else "product_id <> 'p1'")
    for some in (rows, rows.limit(0)):
        got = rejects.route(spark, some, rejects.product_reject_reason(), work_path(spark, f"routed-{uuid.uuid4().hex}"))
        n = some.count()
        assert (got.loaded.count(), got.rejects.count()) == ((n, 0) if keep else (0, n)) == (got.rows_loaded, got.rows_rejected)


def test_digits_that_would_be_lost(spark):
    df = spark.createDataFrame([("1.2345",), ("1.23450",), ("1.23456",), ("7",), ("1e-5",), ("",), ("x",)], "t string")
    got = [r[0] and str(r[0]) for r in df.select(clean.text_to_decimal("t", clean.SIZE_DECIMAL, "lenient")).collect()]
    assert got == ["1.2345", "1.2345", None, "7.0000", None, None, None]
    with pytest.raises(PySparkException, match="at most 4 decimals: 1.23456"):
        df.limit(3).select(clean.text_to_decimal("t", clean.SIZE_DECIMAL)).collect()


def test_unlisted_payment_types_have_a_channel_of_their_own(spark):
    payments = spark.createDataFrame([("a", "1", "card"), ("b", "1", "pix"), ("c", "1", None)], "order_id string, payment_sequential string, payment_type string")
    assert {r.order_id: r.channel for r in extensions.channel_of_payments(payments).collect()} == {"a": "Website", "b": "Other", "c": "Other"}
