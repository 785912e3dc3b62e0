import random
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import profile, repeats, validate


@pytest.fixture
def rows(spark):
    rng = random.Random(3)
    some = [(rng.choice([None, "a", "b", f"id{i}"]), rng.choice([None, 1, i]), f"text {i % 90}") for i in range(300)]
    return spark.createDataFrame(some + [("hot", 7, "same")] * 150, "id string, no int, message string").repartition(5)


@pytest.mark.parametrize("key", [["id"], ["id", "no"], ["no", "message"], ["id", "no", "message"]])
def test_equal_to_one_pass(rows, key):
    got, want = repeats.duplicate_rows(rows, key), profile.duplicate_keys(rows, key)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) != []


def test_equal_digests_are_not_taken_for_copies(rows, monkeypatch):
    monkeypatch.setattr(repeats, "_digest", lambda df, key: F.lit(1).cast("long"))
    got, want = repeats.duplicate_rows(rows, ["id", "no"]), profile.duplicate_keys(rows, ["id", "no"])
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_many_repeated_digests_are_not_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(repeats, "fits_broadcast", lambda df: False)
    got, want = repeats.duplicate_rows(rows, ["message"]), profile.duplicate_keys(rows, ["message"])
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert "Broadcast" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_violations_as_one_by_one(rows):
    keys = [("id",), ("id", "no"), ("message",)]
    got = repeats.key_violations([("x.t", rows, keys[:2]), ("x.u", rows, keys[2:])])
    want = [validate.pk_violations(rows, t, k).first() for t, k in zip(("x.t", "x.t", "x.u"), keys, strict=True)]
    assert sorted(got.collect()) == sorted(want)


def test_first_pass_scans_a_table_once_and_moves_digests_only(spark, tmp_path):
    spark.range(50).selectExpr("cast(id as string) id", "id % 7 as no", "repeat('long text', 100) as message").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = repeats.repeated_digests([(table, [("id",), ("id", "no", "message")])])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    moved = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert moved and all(re.fullmatch(r"k#\d+, digest#\d+L?, \d+", m) for m in moved)
    partial = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan)
    assert partial and not any("message" in keys for keys in partial)


def test_without_repeats_there_is_no_second_pass(spark):
    rows = spark.range(20).selectExpr("id", "cast(id as string) as name")
    found = repeats.duplicate_rows(rows, ["id", "name"])
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString() and found.collect() == []
    assert repeats.duplicate_rows(rows.limit(0), ["id"]).collect() == []
