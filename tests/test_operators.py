from collections import Counter
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.functions import measures
from tallyhouse.operators import keys as keys_module
from tallyhouse.operators import profile as prof
from tallyhouse.operators import validate as val
from tallyhouse.operators.keys import assign_keys, insert_identity, insert_if_absent, with_unknown
from tallyhouse.plans import dims, extensions, facts, reports
from tallyhouse.sources.schemas import CORE_CONTRACTS, RAW_SCHEMAS
from tallyhouse.streaming import fulfilment


# --- keys --------------------------------------------------------------------------------------


def test_keys_are_dense_and_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(F.concat(F.lit("c"), F.col("id")).alias("k"))
    results = []
    for parts in (1, 3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        results.append({r["k"]: r["pk"] for r in assign_keys(df.repartition(parts), "pk").collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
    assert sorted(results[0].values()) == list(range(1, 5001))


def test_copies_get_a_key_each(spark, monkeypatch):
    monkeypatch.setattr(keys_module, "_COPIES_PER_TASK", 10)
    df = spark.range(300).select(F.when(F.col("id") < 100, -1).otherwise(F.col("id")).alias("k"), F.lit(None).cast("int").alias("v"))
    rows = assign_keys(df, "pk", unique=False).collect()
    assert sorted(r["pk"] for r in rows) == list(range(1, 301))
    assert Counter(r["k"] for r in rows)[-1] == 100
    copies = sorted(r["pk"] for r in rows if r["k"] == -1)
    assert copies == list(range(copies[0], copies[0] + 100))


def test_no_window_over_all_rows(spark):
    """The only window without partitions runs over bucket sizes."""
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    plan = assign_keys(df, "pk")._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) <= 1


def test_insert_identity_is_unique(spark):
    df = insert_identity(spark.range(1000).repartition(7), "pk")
    assert df.select("pk").distinct().count() == 1000


def test_insert_if_absent(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    seeds = [{"k": -1, "v": "Unknown"}, {"k": 2, "v": "ignored"}, {"k": -1, "v": "again"}]
    once = insert_if_absent(df, seeds[:2], "k")
    assert sorted(map(tuple, once.collect())) == [(-1, "Unknown"), (1, "a"), (2, "b")]
    assert insert_if_absent(once, seeds[:2], "k").count() == 3
    assert insert_if_absent(df, seeds, "k").count() == 3


def test_with_unknown_fills_missing_columns_with_null(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "pk long, name string, size double")
    rows = with_unknown(df, {"pk": -1, "name": "Unknown"}).collect()
    assert (-1, "Unknown", None) in [tuple(r) for r in rows]


# --- profiling ---------------------------------------------------------------------------------


def test_duplicate_keys_and_whole_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "x"), (None, "y")], "k int, v string")
    assert [tuple(r) for r in prof.duplicate_keys(df, ["k"]).collect()] == [(1, 3), (None, 2)]
    assert [tuple(r) for r in prof.duplicate_keys(df, df.columns).collect()] == [(1, "a", 2)]


def test_null_and_blank_profiles(spark):
    df = spark.createDataFrame([("", None), ("x", ""), (None, "y")], "a string, b string")
    assert tuple(prof.null_profile(df, {"a": "a", "b": "b"}).first()) == (3, 1, 1)
    assert tuple(prof.blank_profile(df, {"a": "a", "b": "b"}).first()) == (1, 1)


def test_orphans_count_rows_and_keep_null_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert Counter(map(tuple, prof.orphans(child, parent, "k").collect())) == Counter([("b", 2), (None, 1)])


def test_casing_and_whitespace(spark):
    df = spark.createDataFrame([("sao paulo",), ("sao paulo",), ("RIO",), ("Belo Horizonte",), (" x",), ("X ",)], "c string")
    assert [tuple(r) for r in prof.casing_issues(df, "c").collect()] == [("sao paulo", 2), (" x", 1)]
    assert Counter(map(tuple, prof.whitespace_issues(df, "c").collect())) == Counter([(" x", 1), ("X ", 1)])
    assert prof.casing_issues(df, "c", 1).count() == 1


def test_pattern_violations_limit(spark):
    df = spark.range(50).select(F.concat(F.lit("x"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("c"))
    assert [r["c"] for r in prof.pattern_violations(df, "c", r"\A\d+\z").collect()] == [f"x{i:02d}" for i in range(20)]


# --- dimensions and facts ----------------------------------------------------------------------


def raw(spark, name, rows):
    columns = RAW_SCHEMAS[name].fieldNames()
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows], RAW_SCHEMAS[name])


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")

    def stored(name, df):
        df.coalesce(1).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    customers = raw(
        spark,
        "raw_customers",
        [
            {"customer_id": "c1", "customer_city": " sao paulo "},
            {"customer_id": "c1", "customer_city": "SAO PAULO"},
            {"customer_id": "c2", "customer_city": "rio"},
            {"customer_id": "c2", "customer_city": "niteroi"},
        ],
    )
    products = raw(
        spark,
        "raw_products",
        [
            {"product_id": "p1", "product_category_name": "toys", "product_weight_g": "12.5"},
            {"product_id": "p2", "product_category_name": ""},
            {"product_id": "p3", "product_category_name": "pc_gamer"},
        ],
    )
    translation = raw(
        spark,
        "raw_product_category_translation",
        [{"product_category_name": "toys", "product_category_name_english": "Toys"}],
    )
    sellers = raw(spark, "raw_sellers", [{"seller_id": "s1", "seller_city": "d'oeste", "seller_state": "SP"}])
    orders = raw(
        spark,
        "raw_orders",
        [
            {
                "order_id": "o1",
                "customer_id": "c1",
                "order_status": "delivered",
                "order_purchase_timestamp": "2017-10-02 23:59:00",
                "order_approved_at": "2017-10-03 00:01:00",
                "order_delivered_carrier_date": "2017-10-01 10:00:00",
                "order_delivered_customer_date": "2017-10-10 10:00:00",
            },
            {"order_id": "o2", "customer_id": "c2", "order_status": "created"},
            {"order_id": "o3", "customer_id": "gone", "order_purchase_timestamp": "2018-01-01 00:00:00"},
        ],
    )
    items = raw(
        spark,
        "raw_order_items",
        [
            {"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "price": "9.90", "freight_value": ""},
            {"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "price": "9.90", "freight_value": ""},
            {"order_id": "o2", "order_item_id": "1", "product_id": "none", "seller_id": "none", "price": "1", "freight_value": "2.5"},
            {"order_id": "o3", "order_item_id": "1", "product_id": "p2", "seller_id": "s1", "price": "3.33", "freight_value": "0"},
            {"order_id": "lost", "order_item_id": "1", "product_id": "p2", "seller_id": "s1", "price": "7", "freight_value": "0"},
        ],
    )
    items, orders, products = stored("items", items), stored("orders", orders), stored("products", products)
    dim = {
        "customer": stored("dim_customer", dims.build_dim_customer(customers)),
        "product": stored("dim_product", dims.build_dim_product(products, translation)),
        "store": stored("dim_store", dims.build_dim_store(sellers)),
    }
    resolved = stored("resolved", facts.resolve_orders(orders, dim["customer"]))
    return {"items": items, "orders": orders, "resolved": resolved, "products": products, "dim": dim}


def test_dimensions(spark, shop):
    customer = shop["dim"]["customer"].collect()
    # One spelling after cleaning is one member; two cities of one customer are two.
    assert Counter(r["customer_id"] for r in customer) == Counter({"c1": 1, "c2": 2, "-1": 1})
    assert {r["customer_city"] for r in customer} == {"Sao Paulo", "Rio", "Niteroi", "Unknown"}
    product = {r["product_id"]: r for r in shop["dim"]["product"].collect()}
    assert {k: r["product_category_name_english"] for k, r in product.items()} == {
        "p1": "Toys",
        "p2": "Unknown Category",
        "p3": "Unknown Category",
        "-1": "Unknown Category",
    }
    assert product["p1"]["product_weight_g"] == Decimal("12.5000") and product["p2"]["product_weight_g"] is None
    assert product["-1"]["product_pk"] == -1
    assert {r["store_city"] for r in shop["dim"]["store"].collect()} == {"D'Oeste", "Unknown"}


def test_repeated_translation_fans_out_products(spark, shop):
    twice = raw(
        spark,
        "raw_product_category_translation",
        [
            {"product_category_name": "toys", "product_category_name_english": "Toys"},
            {"product_category_name": "toys", "product_category_name_english": "Games"},
        ],
    )
    dim = dims.build_dim_product(shop["products"], twice)
    assert dim.count() == 5
    found = val.pk_violations(dim, "dim_product", ("product_id",)).first()
    assert (found["repeated_keys"], found["surplus_rows"]) == (1, 1)
    assert val.pk_violations(dim, "dim_product", ("product_pk",)).first()["repeated_keys"] == 0


def test_fact(spark, shop):
    d = shop["dim"]
    fact = facts.build_fact_sales(shop["items"], shop["resolved"], d["product"], d["store"])
    rows = fact.collect()
    by_order = Counter(r["order_id"] for r in rows)
    # The copy stays, the line without an order goes, the customer with two cities doubles.
    assert by_order == Counter({"o1": 2, "o2": 2, "o3": 1})
    first = next(r for r in rows if r["order_id"] == "o1")
    assert (first["price"], first["freight_value"]) == (Decimal("9.90"), Decimal("0.00"))
    assert (first["product_cost"], first["profit"]) == (Decimal("6.44"), Decimal("3.47"))
    assert first["date_fk"] == 20171002 and first["channel"] == "Website" and first["quantity"] == 1
    second = next(r for r in rows if r["order_id"] == "o2")
    assert (second["date_fk"], second["product_fk"], second["store_fk"]) == (19000101, -1, -1)
    third = next(r for r in rows if r["order_id"] == "o3")
    assert third["customer_fk"] == -1
    assert [r["order_id"] for r in prof.orphans(shop["items"], shop["orders"], "order_id").collect()] == ["lost"]


def test_monthly_leaves_undated_lines_out(spark, shop):
    d = shop["dim"]
    fact = facts.build_fact_sales(shop["items"], shop["resolved"], d["product"], d["store"])
    calendar = dims.build_dim_date(dims.data_bounds(shop["orders"]))
    monthly = facts.build_monthly(fact, calendar)
    assert {(r["month_fk"], r["quantity"], r["revenue"]) for r in monthly.collect()} == {
        (201710, 2, Decimal("19.80")),
        (201801, 1, Decimal("3.33")),
    }
    check = val.mart_reconciliation(monthly, fact).first()
    assert check["difference"] == 0 and check["mart_total_revenue"] == Decimal("23.13")


def test_reconciliation_shows_a_loss(spark, shop):
    d = shop["dim"]
    fact = facts.build_fact_sales(shop["items"], shop["resolved"], d["product"], d["store"])
    short = dims.build_dim_date(dims.fixed_bounds(spark, "2017-01-01", "2017-12-31"))
    assert val.mart_reconciliation(facts.build_monthly(fact, short), fact).first()["difference"] == Decimal("-3.33")
    bad = val.fk_violations(fact, "fact", "date_fk", short, "dim_date", "date_id").first()
    assert (bad["missing_keys"], bad["rows"]) == (1, 1)
    counts = val.fk_validation(fact, {"date": (short, "date_fk", "date_id")}).collect()
    assert [tuple(r) for r in counts] == [("baseline_fact_rows", 5), ("matched_date", 4)]


def test_snapshot(spark, shop):
    rows = {r["order_id"]: r for r in facts.build_fulfilment(shop["resolved"]).collect()}
    assert (rows["o1"]["days_to_approve"], rows["o1"]["days_to_ship"], rows["o1"]["days_to_deliver"]) == (1, -2, 9)
    assert rows["o2"]["order_date_fk"] == 19000101 and rows["o2"]["days_to_approve"] is None
    assert rows["o3"]["customer_fk"] == -1


def test_blank_price_fails_strictly_and_is_split_in_quarantine(spark, shop):
    d = shop["dim"]
    spoiled = shop["items"].withColumn(
        "price", F.when(F.col("order_id") == "o2", "").when(F.col("order_id") == "o3", "x").otherwise(F.col("price"))
    )
    with pytest.raises(PySparkException, match="missing value in price|not a number"):
        facts.build_fact_sales(spoiled, shop["resolved"], d["product"], d["store"]).collect()
    good, rejects = facts.split_rejects(spoiled)
    assert Counter(r["reject_reason"] for r in rejects.collect()) == Counter({"blank price": 1, "bad price": 1})
    assert good.count() + rejects.count() == spoiled.count()
    assert facts.build_fact_sales(good, shop["resolved"], d["product"], d["store"]).count() == 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_price_out_of_range_fails(spark, shop, ansi):
    big = shop["items"].withColumn("price", F.lit("123456789.00"))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="out of range"):
            facts.line_measures(big).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert facts.split_rejects(big)[0].count() == 0


def test_calendar_of_a_fixed_range(spark):
    calendar = dims.build_dim_date(dims.fixed_bounds(spark, "2016-01-01", "2018-12-31"))
    assert calendar.count() == 1096 + 1
    assert calendar.where("date_id = 19000101").first()["day_name"] == "Unknown"
    assert dims.build_dim_month(calendar).count() == 36
    holidays = spark.sql("select date'2016-12-25' full_date union all select date'2016-12-25'")
    marked = dims.build_dim_date(dims.fixed_bounds(spark, "2016-12-24", "2016-12-26"), holidays)
    assert [r["date_id"] for r in marked.where("is_holiday_flag").collect()] == [20161225]


def test_ytd_restarts_each_year(spark):
    monthly = spark.createDataFrame(
        [(201611, Decimal("1.00")), (201612, Decimal("2.00")), (201701, Decimal("4.00")), (201703, Decimal("8.00"))],
        "month_fk int, revenue decimal(12,2)",
    )
    months = dims.build_dim_month(dims.build_dim_date(dims.fixed_bounds(spark, "2016-01-01", "2017-12-31")))
    got = [(r["month_id"], int(r["ytd_revenue"])) for r in reports.ytd_revenue(monthly, months).collect()]
    assert got == [(201611, 1), (201612, 3), (201701, 4), (201703, 12)]


def test_margin_without_revenue_is_null(spark):
    monthly = spark.createDataFrame([(201611, 0.0, 0.0)], "month_fk int, revenue double, profit double")
    assert reports.profit_margin(monthly).first()[0] is None


# --- validation --------------------------------------------------------------------------------


def test_not_null_and_domain_checks(spark):
    contract = CORE_CONTRACTS["dim_store"]
    df = spark.createDataFrame(
        [(1, None, "x" * 101, "SP", "1"), (2, "s", "y", "MIDDLE EAST", None)], ", ".join(f"{c} {t}" for c, t in contract.columns.items())
    )
    nulls = {r["column_name"]: r["n"] for r in val.not_null_violations(df, "t", contract).collect()}
    assert nulls == {"store_pk": 0, "seller_id": 1}
    long = {r["column_name"]: r["n"] for r in val.domain_violations(df, "t", contract).collect()}
    assert long == {"seller_id": 0, "store_city": 1, "store_state": 1, "store_zip_code_prefix": 0}
    wide = spark.createDataFrame([(Decimal("123456789.00"),)], "price decimal(20,2)")
    fact = CORE_CONTRACTS["fact_sales"]
    rule = [(("price", "decimal(10,2)"), F.col("price").try_cast("decimal(10,2)").isNull())]
    assert wide.where(rule[0][1]).count() == 1 and "price" in fact.decimals
    assert val.contract_types(wide, fact)[0].startswith("sales_fact_pk")


# --- beyond the scripts ------------------------------------------------------------------------


def test_channels_follow_their_shares(spark):
    orders = spark.range(20000).select(F.col("id").cast("string").alias("order_id"))
    shares = {r["channel"]: r["count"] / 20000 for r in extensions.assign_channel(orders).groupBy("channel").count().collect()}
    for name, percent in extensions.CHANNEL_SHARES.items():
        assert abs(shares[name] - percent / 100) < 0.02
    with pytest.raises(ValueError):
        extensions.assign_channel(orders, {"a": 50})
    only = extensions.assign_channel(orders, {"a": 100}).select("channel").distinct().collect()
    assert [r["channel"] for r in only] == ["a"]


def test_growth_needs_the_year_before(spark):
    fact = spark.createDataFrame(
        [("A", 20160101, Decimal("10.00")), ("A", 20180101, Decimal("30.00")), ("A", 20190101, Decimal("15.00"))],
        "channel string, date_fk int, sales_amount decimal(10,2)",
    )
    growth = {r["year"]: r["growth"] for r in extensions.yoy_growth_by_channel(fact).collect()}
    assert growth == {2016: None, 2018: None, 2019: -0.5}


def test_channel_of_first_payment(spark):
    payments = raw(
        spark,
        "raw_order_payments",
        [
            {"order_id": "o", "payment_sequential": "10", "payment_type": "voucher"},
            {"order_id": "o", "payment_sequential": "2", "payment_type": "wallet"},
            {"order_id": "q", "payment_sequential": "1", "payment_type": "other"},
        ],
    )
    assert {r["order_id"]: r["channel"] for r in extensions.channel_of_payments(payments).collect()} == {"o": "App", "q": "Other"}


# --- fulfilment upkeep -------------------------------------------------------------------------


def report_row(order, status, placed="", approved="", shipped="", delivered=""):
    return {
        "order_id": order,
        "customer_id": "c",
        "order_status": status,
        "order_purchase_timestamp": placed,
        "order_approved_at": approved,
        "order_delivered_carrier_date": shipped,
        "order_delivered_customer_date": delivered,
    }


def test_upsert_keeps_known_milestones(spark):
    first = raw(spark, "raw_orders", [report_row("o1", "processing", "2017-01-01 10:00:00", "2017-01-02 10:00:00")])
    later = raw(
        spark,
        "raw_orders",
        [
            report_row("o1", "shipped", shipped="2017-01-04 10:00:00"),
            report_row("o1", "processing", approved="2017-01-03 10:00:00"),
            report_row("o2", "processing", "2017-01-05 10:00:00"),
        ],
    )
    state, batch = fulfilment.order_reports(first), fulfilment.order_reports(later)
    once = fulfilment.fulfilment_upsert(state, batch)
    twice = fulfilment.fulfilment_upsert(once, batch)
    assert Counter(map(tuple, once.collect())) == Counter(map(tuple, twice.collect()))
    o1 = once.where("order_id = 'o1'").first()
    assert (str(o1["order_date"]), str(o1["approved_date"]), str(o1["shipped_date"])) == ("2017-01-01", "2017-01-02", "2017-01-04")
    assert o1["order_status"] == "shipped" and o1["delivered_date"] is None


def test_stream_resumes_and_compacts(spark, tmp_path):
    source, state, mark = (str(tmp_path / n) for n in ("orders", "state", "mark"))

    def arrive(*rows):
        raw(spark, "raw_orders", list(rows)).coalesce(1).write.mode("append").parquet(source)
        fulfilment.follow_orders(spark, source, state, mark).awaitTermination()

    arrive(report_row("o1", "processing", "2017-01-01 10:00:00"), report_row("o2", "processing", "2017-01-01 10:00:00"))
    arrive(report_row("o1", "shipped", shipped="2017-01-04 10:00:00"))
    fulfilment.follow_orders(spark, source, state, mark).awaitTermination()  # nothing new
    now = {r["order_id"]: r for r in fulfilment.read_state(spark, state).collect()}
    assert str(now["o1"]["order_date"]) == "2017-01-01" and str(now["o1"]["shipped_date"]) == "2017-01-04"
    assert now["o1"]["order_status"] == "shipped" and now["o2"]["order_status"] == "processing"

    moved = str(tmp_path / "compacted")
    fulfilment.compact_state(spark, state, moved)
    state = moved
    arrive(report_row("o2", "delivered", delivered="2017-01-09 10:00:00"))
    after = {r["order_id"]: r for r in fulfilment.read_state(spark, moved).collect()}
    assert str(after["o1"]["shipped_date"]) == "2017-01-04" and after["o2"]["order_status"] == "delivered"
    assert len(after) == 2


def test_status_of_any_life_cycle(spark):
    rows = [
        report_row("o1", "created"), report_row("o1", "approved"),
        report_row("o2", "processing"), report_row("o2", "canceled"), report_row("o2", "shipped"),
        report_row("o3", "invoiced"), report_row("o3", "unavailable"),
        report_row("o4", ""), report_row("o4", "created"),
    ]
    merged = fulfilment.merge_milestones(fulfilment.order_reports(raw(spark, "raw_orders", rows)))
    assert {r["order_id"]: r["order_status"] for r in merged.collect()} == {
        "o1": "approved", "o2": "canceled", "o3": "unavailable", "o4": "created"
    }
    strange = fulfilment.order_reports(raw(spark, "raw_orders", [report_row("o5", "teleported")]))
    with pytest.raises(Exception, match="teleported"):
        fulfilment.merge_milestones(strange).collect()


def test_daily_channels_hold_all_revenue(spark):
    fact = spark.createDataFrame(
        [(20170101, "Website", Decimal("1.00")), (20170101, "Fax", Decimal("3.00")), (20190101, "App", Decimal("2.00"))],
        "date_fk int, channel string, sales_amount decimal(10,2)",
    )
    dates = spark.createDataFrame([(19000101,), (20170101,), (20170102,)], "date_id int")
    rows = extensions.daily_channel_snapshot(fact, dates).collect()
    assert sum(r["revenue"] for r in rows) == Decimal("6.00")
    assert len(rows) == 3 * 4 and {r["channel"] for r in rows} == {"Website", "App", "Pop-up store", "Fax"}


def test_amounts_of_several_pieces(spark):
    items = spark.createDataFrame([("10.00", "1.00")], "price string, freight_value string")
    row = facts.line_measures(items, quantity=3).first()
    assert (row["price"], row["sales_amount"], row["quantity"]) == (Decimal("10.00"), Decimal("30.00"), 3)
    assert row["product_cost"] + row["profit"] == Decimal("30.00")


def test_ratios_are_not_averaged():
    for name in ("profit_margin", "unit_price"):
        with pytest.raises(measures.NotAdditive):
            measures.average(name)
