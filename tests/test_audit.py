"""Checks of many tables in one scan each, against the checks one by one."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import audit, profile


def checks():
    return [
        ("blank", "note", F.col("note") == ""),
        ("long", "note", F.length("note") > 3),
        ("never", "note", F.col("note") == "nothing is like this"),
    ]


@pytest.fixture(params=["copied", "large"])
def tables(request, spark, tmp_path):
    rng = random.Random(8)
    lines = [(rng.choice([None, "hot", f"o{i % 90}"]), str(rng.randint(1, 3)), rng.choice([None, "", "ab", "abcd"])) for i in range(400)]
    orders = [(None, "c1")] + [(f"o{i}", rng.choice([None, "c1", "c2", "lost"])) for i in range(0, 90, 2)] * 2
    shop = {
        "lines": spark.createDataFrame(lines, "order_id string, no string, note string"),
        "orders": spark.createDataFrame(orders, "order_id string, customer_id string"),
        "customers": spark.createDataFrame([("c1",), (None,), ("c2",)], "customer_id string"),
    }
    for name, df in shop.items():
        df.write.parquet(f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if request.param == "copied" else "-1")
    yield request.param, {name: spark.read.parquet(f"{tmp_path}/{name}") for name in shop}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def issues():
    return [
        *[audit.Check("lines", issue, column, "format", "fix", test) for issue, column, test in checks()],
        audit.Reference("lines", "orphan", "order_id", "key", "fix", "orders"),
        audit.Reference("orders", "orphan", "customer_id", "key", "fix", "customers"),
        audit.Unique("lines", "copies", "order_id,no", "key", "fix", ("order_id", "no")),
        audit.Unique("orders", "copies", "order_id", "key", "fix", ("order_id",)),
        audit.Unique("customers", "copies", "customer_id", "key", "fix", ("customer_id",)),
    ]


def one_by_one(shop):
    def total(df, less=0):
        return df.agg(F.coalesce(F.sum(F.col("n") - less), F.lit(0))).first()[0]

    return {
        **{("lines", issue): shop["lines"].where(test).count() for issue, _, test in checks()},
        ("lines", "orphan"): total(profile.orphans(shop["lines"], shop["orders"], "order_id")),
        ("orders", "orphan"): total(profile.orphans(shop["orders"], shop["customers"], "customer_id")),
        ("lines", "copies"): total(profile.duplicate_keys(shop["lines"], ["order_id", "no"]), 1),
        ("orders", "copies"): total(profile.duplicate_keys(shop["orders"], ["order_id"]), 1),
        ("customers", "copies"): 0,
    }


def test_as_one_by_one(tables):
    _, shop = tables
    got = audit.issue_counts(shop, issues()).collect()
    assert {(r.table_name, r.issue): r.n for r in got} == one_by_one(shop)
    assert len(got) == len(issues())


def test_equal_digests_are_not_taken_for_copies(tables, monkeypatch):
    _, shop = tables
    monkeypatch.setattr(audit, "_digest", lambda df, key: F.lit(1).cast("long"))
    got = audit.issue_counts(shop, issues()).collect()
    assert {(r.table_name, r.issue): r.n for r in got} == one_by_one(shop)


def test_each_table_is_scanned_once(tables):
    kind, shop = tables
    plan = audit.entries(shop, issues())._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("Relation [")
    # Small tables that others refer to are read once more, to be copied.
    assert scans == (5 if kind == "copied" else 3)


def test_empty_tables(tables):
    _, shop = tables
    got = audit.issue_counts({name: df.limit(0) for name, df in shop.items()}, issues()).collect()
    assert [r.n for r in got] == [0] * len(issues())


def test_plan_of_a_large_table_shuffles_no_key_of_a_small_one(tables):
    kind, shop = tables
    found = audit.entries(shop, issues()).where("key is not null")
    by_value = {r.slot for r in found.select("slot").distinct().collect()}
    assert by_value == (set() if kind == "copied" else {3, 4})
