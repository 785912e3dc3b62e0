"""Every registered query of the warehouse against DuckDB: on the given tables, and on tables where single keys
hold a third of the rows, keys are NULL, and dimension members repeat, with broadcasts off."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from parity import TESTDATA, differences, duck
from tallyhouse import oracle, queries
from tallyhouse.plans.warehouse import open_warehouse
from tallyhouse.sources.schemas import CONTRACTS, RAW_SCHEMAS, STAGING

QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()
SMALL = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def small(spark):
    return duck(SMALL)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for file in TESTDATA.joinpath("sf0.001").glob("*.parquet"):
        con.execute(f"CREATE VIEW s_{file.stem} AS SELECT * FROM '{file}'")
    changed = {
        # a third of the lines on one order, a third on one product, half on one store
        "lineitem": """SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
            CASE WHEN l_orderkey % 2 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey) FROM s_lineitem""",
        # a third of the orders by one customer, a tenth by none
        "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 WHEN o_orderkey % 10 = 1 THEN NULL
            ELSE o_custkey END AS o_custkey) FROM s_orders""",
        # members that repeat: a spelling of a customer, exact copies of a product
        "customer": """SELECT * FROM s_customer UNION ALL
            SELECT * REPLACE (c_nationkey + 1 AS c_nationkey) FROM s_customer WHERE c_custkey IN (4, 20)""",
        "part": "SELECT * FROM s_part UNION ALL SELECT p.* FROM s_part p, range(80) WHERE p_partkey = 17",
    }
    for file in TESTDATA.joinpath("sf0.001").glob("*.parquet"):
        sql = changed.get(file.stem, f"SELECT * FROM s_{file.stem}")
        con.execute(f"COPY ({sql}) TO '{folder}/{file.name}' (FORMAT parquet)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield str(folder), duck(str(folder))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_small(spark, small, name):
    _, problem = differences(QUERIES[name](spark, SMALL), small, ORACLE[name])
    assert not problem


@pytest.mark.parametrize(
    "name",
    [
        name
        for name in QUERIES
        if not name.startswith(("csv_", "list_", "null_profile", "blank_profile", "flatten", "peek", "dim_date"))
    ],
)
def test_skewed(spark, skewed, name):
    folder, con = skewed
    _, problem = differences(QUERIES[name](spark, folder), con, ORACLE[name])
    assert not problem


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows[0]["product_category_name_english"] == "Unknown Category"
    assert str(rows[0]["revenue"]) == "73271944.75"


# Rows, sums of price, freight, cost and profit, lines off by a cent, unknown members, and the
# monthly roll-up, measured on the given tables.
ANCHORS = {
    "0.001": {
        "fact": (6000, "317364757.31", "23987.00", "206287093.80", "111077666.24", 273),
        "unknown": (67, 44, 125, 610),
        "monthly": (5806, 5933, "313603701.87", "203842407.79", "109761296.79"),
        "snapshot": (1500, 1484, 1483, 991, 484, 2202, -593235, 649056, 735),
        "ytd": (80, "1994524831.44"),
    },
    "0.01": {
        "fact": (60000, "3183256271.63", "239589.00", "2069116591.77", "1114139709.91", 3005),
        "unknown": (586, 295, 1116, 6018),
        "monthly": (59075, 59414, "3150826877.24", "2048037485.26", "1102789421.71"),
        "snapshot": (15000, 14845, 14831, 9743, 4859, 22018, -6099076, 6497256, 7320),
        "ytd": (80, "19961325292.18"),
    },
}


@pytest.mark.parametrize("sf", ANCHORS)
def test_anchors(spark, sf):
    folder = str(TESTDATA / f"sf{sf}")
    w, _ = open_warehouse(spark, folder)
    want = ANCHORS[sf]

    def row(df, *exprs):
        return tuple(str(v) if not isinstance(v, int) else v for v in df.selectExpr(*exprs).first())

    assert want["fact"] == row(
        w.core("fact_sales"),
        "count(*)",
        "sum(price)",
        "sum(freight_value)",
        "sum(product_cost)",
        "sum(profit)",
        "count_if(product_cost + profit <> sales_amount)",
    )
    assert want["unknown"] == tuple(QUERIES["dummy_key_counts"](spark, folder).first())
    assert want["monthly"] == row(
        w.mart("fact_revenue_by_month"), "count(*)", "sum(quantity)", "sum(revenue)", "sum(cost)", "sum(profit)"
    )
    keys = ["order_date_fk", "approved_date_fk", "shipped_date_fk", "delivered_date_fk"]
    assert want["snapshot"] == row(
        w.mart("order_fulfilment_snapshot"),
        "count(*)",
        *[f"count_if({k} <> 19000101)" for k in keys],
        *[f"sum(days_to_{d})" for d in ("approve", "ship", "deliver")],
        "count_if(days_to_ship < 0)",
    )
    assert want["ytd"] == row(QUERIES["ytd_revenue"](spark, folder), "count(*)", "sum(ytd_revenue)")


def test_reload_repeats_every_table(spark):
    """Loading all layers again gives the same rows, with the same keys."""
    w, _ = open_warehouse(spark, SMALL)

    def fingerprints():
        out = {}
        for layer, contracts in CONTRACTS.items():
            for name, contract in contracts.items():
                df = (w.core if layer == "core" else w.mart)(name)
                kept = [c for c in df.columns if c != "sales_fact_pk"]  # the one id that is only unique
                row = df.selectExpr(f"xxhash64({','.join(kept)}) AS h").selectExpr("sum(h % 1000000007)", "count(*)")
                out[layer, name] = tuple(row.first())
        return out

    before = fingerprints()
    for name in RAW_SCHEMAS:
        w.load(STAGING, name, reload=True)
    w.load_all()
    assert fingerprints() == before
