"""Plans that stay narrow: what is computed once, and what passes a shuffle."""

import time
import uuid
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.operators import validate
from tallyhouse.operators.keys import assign_group_keys, assign_keys
from tallyhouse.plans import facts
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import work_root
from tallyhouse.sources import raw
from tallyhouse.sources.layers import Steps, read_table
from tallyhouse.sources.schemas import CORE, MART, RAW_SCHEMAS


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rejects_compute_their_input_once(spark):
    items = spark.createDataFrame(
        [("1", "1", "7.50", ""), ("2", "1", "7.50", ""), ("3", "x", "1.00", ""), ("4", "1", "1.00", "y"), ("5", "1", None, None)],
        "order_id string, order_item_id string, price string, freight_value string",
    )
    spoiled = items.withColumn("price", F.when(F.col("order_id") == "2", F.concat(F.lit("R$"), "price")).otherwise(F.col("price")))
    good, bad = facts.split_rejects(spoiled)
    assert good.columns == items.columns and [r.order_id for r in good.collect()] == ["1"]
    assert {r.order_id: r.reject_reason for r in bad.collect()} == {"2": "bad price", "3": "bad order item", "4": "bad freight value", "5": "blank price"}
    for df in (facts.line_measures(good), bad):
        assert plan(df).count("R$") == 1


def shuffled(df):
    """What each shuffle of a plan moves, by the columns of the plan below it."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while nodes:
        node = nodes.pop()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            found.append({node.output().apply(i).name() for i in range(node.output().size())})
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def lines(spark):
    return spark.createDataFrame(
        [("o1", "1", "p1", "s1", "7.505", "1.00"), ("o1", "2", "p9", "s9", "0.10", ""), ("o2", "1", "p1", "s1", "3.00", ""), ("o9", "1", "p1", "s1", "3.00", "")],
        "order_id string, order_item_id string, product_id string, seller_id string, price string, freight_value string",
    )


def orders(spark):
    return spark.createDataFrame(
        [("o1", "shipped", date(2017, 5, 6), 4), ("o2", "shipped", None, 5)], "order_id string, order_status string, order_date date, customer_fk long"
    )


def sales(spark, **options):
    products = spark.createDataFrame([("p1", 11)], "product_id string, product_pk long")
    stores = spark.createDataFrame([("s1", 21)], "seller_id string, store_pk long")
    return facts.build_fact_sales(options.pop("items", lines(spark)), orders(spark), products, stores, **options)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_derived_amounts_pass_no_shuffle(spark, no_broadcast):
    fact = sales(spark, by_month=True)
    moved = shuffled(fact)
    assert moved and all(not {"product_cost", "profit", "sales_amount", "quantity", "channel"} & columns for columns in moved)
    got = {(r.order_id, r.order_item_id): r for r in fact.collect()}
    assert set(got) == {("o1", 1), ("o1", 2), ("o2", 1)}
    r = got["o1", 1]  # cost and profit are those of the price before it is rounded
    assert (r.price, r.product_cost, r.profit, r.sale_month, r.product_fk, r.store_fk) == (Decimal("7.51"), Decimal("4.88"), Decimal("2.63"), 201705, 11, 21)
    assert (got["o1", 2].product_fk, got["o1", 2].store_fk, got["o2", 1].date_fk) == (-1, -1, 19000101)


@pytest.mark.parametrize("options, price", [({}, "x"), ({}, ""), ({"quantity": 3}, "60000000"), ({"cost_ratio": Decimal(3)}, "60000000")])
def test_lines_without_an_order_are_checked_too(spark, options, price):
    spoiled = lines(spark).withColumn("price", F.when(F.col("order_id") == "o9", price).otherwise(F.col("price")))
    with pytest.raises(PySparkException):
        sales(spark, items=spoiled, **options).collect()


def test_order_dates_pass_the_shuffle_as_dates(spark, no_broadcast):
    raw_orders = spark.createDataFrame(
        [("c1", "o1", "shipped", "2017-05-06 10:00:00", "", "", "")],
        "customer_id string, order_id string, order_status string, order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string",
    )
    resolved = facts.resolve_orders(raw_orders, spark.createDataFrame([("c1", 4)], "customer_id string, customer_pk long"))
    assert not any("order_purchase_timestamp" in columns for columns in shuffled(resolved))
    assert resolved.collect() == [("o1", 4, date(2017, 5, 6), None, None, None, "shipped")]


def test_digests_pass_no_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    for keyed in (assign_keys(df, "pk"), assign_keys(df, "pk", ["k", "v"]), assign_keys(df, "pk", unique=False)):
        assert not any("_d" in columns for columns in shuffled(keyed))
        digest = F.md5(F.concat_ws("|", F.coalesce("k", F.lit("")), F.col("v").cast("string")))
        assert [r.pk for r in keyed.orderBy(digest).collect()] == [1, 2, 3, 4]


def test_integer_foreign_keys_are_counted_as_numbers(spark):
    fact = spark.createDataFrame([(1, 7), (2, 7), (2, None)], "a long, b int")
    dim = spark.createDataFrame([(1,), (3,)], "pk long")
    missing = validate.missing_members(fact, {"a": (dim, "pk", "d.pk"), "b": (dim, "pk", "d.pk")})
    assert "cast(a" not in plan(missing).lower()
    assert sorted(missing.collect()) == [("a", "2", 2), ("b", "7", 2)]


def test_compressed_csv_is_cut_into_files(spark, monkeypatch):
    monkeypatch.setattr(raw, "ROWS_PER_GZIP", 10)
    path = f"{work_root(spark)}/{uuid.uuid4().hex}"
    rows = spark.range(25).selectExpr(*[f"concat('{c} \"', id, '\"')  {c}" for c in raw.RAW_SCHEMAS["raw_sellers"].fieldNames()][:-1], "'' " + raw.RAW_SCHEMAS["raw_sellers"].fieldNames()[-1])
    raw.write_raw(rows.coalesce(1), path, gzip=True)
    assert len(list(Path(path).glob("*.csv.gz"))) == 3
    assert sorted(raw.load_raw(spark, "raw_sellers", path).collect()) == sorted(rows.collect())


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def kept_folders(spark):
    """Intermediate results that are in the work folder."""
    return {str(p) for name in ("lines", "summed", "placed") for p in Path(work_root(spark)).rglob(f"{name}-*")}


def raw_tables(spark):
    dates = ["2017-05-06 08:15:00", "2017-05-07 00:00:00", "", "", "2017-05-20 00:00:00"]
    rows = {
        "raw_orders": [(f"o{i}", f"c{i % 7}", "shipped", *dates) for i in range(40)] + [("o98", "c1", "shipped", "", *dates[1:])],
        "raw_order_items": [(f"o{i % 42}", str(i), f"p{i % 9}", f"s{i % 4}", "", f"{i}.50", "") for i in range(300)] + [("o98", "1", "p1", "s1", "", "7.00", "")],
        "raw_products": [(f"p{i}", "a", *["1"] * 7) for i in range(8)],
        "raw_product_category_translation": [("a", "A")],
        "raw_sellers": [(f"s{i}", "1", "x", "y") for i in range(3)],
        "raw_customers": [(f"c{i}", f"u{i}", "1", "x", "y") for i in range(6)],
    }
    return {name: spark.createDataFrame(data, RAW_SCHEMAS[name]) for name, data in rows.items()}


def test_a_load_leaves_no_shuffle_files_and_no_steps(spark, no_broadcast):
    tables, name = raw_tables(spark), uuid.uuid4().hex[:8]
    w = Warehouse(spark, lambda n: tables[n], prefix=f"n{name}_", root=f"{work_root(spark)}/{name}")
    files, folders = shuffle_files(spark), kept_folders(spark)
    w.load(MART, "fact_revenue_by_month")
    for _ in range(100):  # they are deleted in the background
        left = shuffle_files(spark) - files
        if not left:
            break
        time.sleep(0.1)
    assert not left and kept_folders(spark) <= folders

    sales, monthly = (read_table(spark, *t, f"n{name}_") for t in ((CORE, "fact_sales"), (MART, "fact_revenue_by_month")))
    again = w.build(CORE, "fact_sales")
    assert sales.select(*again.columns).exceptAll(again).isEmpty() and again.exceptAll(sales.select(*again.columns)).isEmpty()
    expected = assign_keys(w.build(MART, "fact_revenue_by_month"), "revenue_fact_pk", ["month_fk", "product_fk", "store_fk"])
    assert sorted(monthly.select(*expected.columns).collect()) == sorted(expected.collect())
    assert validate.mart_reconciliation(monthly, sales).first()["difference"] == 0


@pytest.mark.parametrize("same", [1, 40])
def test_keyed_groups_are_those_of_summed_lines(spark, no_broadcast, same):
    calendar = spark.createDataFrame([(20170506, 2017, 5), (20170607, 2017, 6)], "date_id int, year int, month int")
    fact = spark.range(200).selectExpr(
        "IF(id % 3 = 0, 20170506, 20170607) AS date_fk", f"id DIV {same} AS product_fk", "id % 1 AS store_fk", "1 AS quantity",
        *[f"cast(id as decimal(10,2)) AS {c}" for c in ("sales_amount", "product_cost", "profit")],
    )
    grain = ["month_fk", "product_fk", "store_fk"]
    assert facts.summing_pays(facts._monthly_lines(fact, calendar)) == (same > 1)
    steps = Steps(spark)
    keyed = facts.build_keyed_monthly(fact, calendar, "pk", steps)
    assert sorted(keyed.collect()) == sorted(assign_keys(facts.build_monthly(fact, calendar), "pk", grain).collect())
    steps.drop()


def test_a_hot_group_is_summed_before_it_moves(spark):
    rows = spark.range(1000).selectExpr("1 AS month_fk", "IF(id % 3 = 0, -1, id) AS product_fk", "1 AS store_fk")
    assert facts.summing_pays(rows)
    assert not facts.summing_pays(rows.where("product_fk >= 0"))


def test_groups_get_their_keys_with_one_shuffle_of_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5)], "k string, v long")
    written = []

    def keep(rows, name):
        written.append((rows, name))
        return rows

    keyed = assign_group_keys(df, "pk", ["k"], {"v": F.sum("v")}, keep)
    assert sorted(keyed.collect(), key=str) == sorted(assign_keys(df.groupBy("k").agg(F.sum("v").alias("v")), "pk", ["k"]).collect(), key=str)
    assert [len(shuffled(rows)) for rows, _ in written] == [1]
