"""Commit log, keys that outlast loads, and merging into the fulfilment snapshot."""

import uuid

import pytest

from tallyhouse.plans.dims import build_dim_store
from tallyhouse.sources.commits import CommitLog, ConflictingWrite
from tallyhouse.sources.keymap import KeyMap
from tallyhouse.sources.merged import MergedTable
from tallyhouse.sources.layers import work_path
from tallyhouse.streaming.fulfilment import FulfilmentSnapshot
from pyspark.sql import functions as F


@pytest.fixture
def path(spark):
    return work_path(spark, f"upkeep-{uuid.uuid4().hex}")


# --- commit log --------------------------------------------------------------------------------


def test_second_writer_from_one_base_is_refused(spark, path):
    one, two = CommitLog(spark, path), CommitLog(spark, path)
    assert one.last() == -1
    first = one.commit(-1, {"who": "one"})
    base = two.last()
    assert base == first and two.read(base) == {"who": "one"}
    assert one.commit(base, {"who": "one again"}) == 1
    with pytest.raises(ConflictingWrite):
        two.commit(base, {"who": "two"})
    assert two.read(two.last()) == {"who": "one again"} and two.numbers() == [0, 1]
    one.forget_before(1)
    assert one.numbers() == [1]


# --- keys --------------------------------------------------------------------------------------


def members(spark, *names):
    return spark.createDataFrame([(n, "x") for n in names], "k string, v string")


def keys(df):
    return sorted((r.key, r.k) for r in df.collect())


def test_old_members_keep_their_keys_and_new_ones_follow(spark, path):
    store = KeyMap(spark, path)
    first = keys(store.keyed(members(spark, "a", "b", "c"), "key"))
    assert [k for k, _ in first] == [1, 2, 3]
    assert keys(KeyMap(spark, path).keyed(members(spark, "c", "a", "b"), "key")) == first
    second = keys(store.keyed(members(spark, "d", "b", "e", None), "key"))
    old = dict((n, k) for k, n in first)
    assert {n: k for k, n in second if n in old} == {"b": old["b"]}
    assert sorted(k for k, n in second if n not in old) == [4, 5, 6]
    assert keys(store.keyed(members(spark, "a", "c"), "key")) == sorted((old[n], n) for n in "ac")
    assert store.size() == 6


def test_copies_have_keys_of_their_own(spark, path):
    store = KeyMap(spark, path)
    first = keys(store.keyed(members(spark, "a", "a", "b"), "key", unique=False))
    assert [k for k, _ in first] == [1, 2, 3]
    more = keys(store.keyed(members(spark, "a", "a", "a", "a", "b", "c"), "key", unique=False))
    assert set(first) < set(more) and [k for k, _ in more] == [1, 2, 3, 4, 5, 6]
    assert keys(store.keyed(members(spark, "a", "b"), "key", unique=False)) == [min(p for p in first if p[1] == "a"), *[p for p in first if p[1] == "b"]]
    with pytest.raises(Exception, match="member given twice"):
        store.keyed(members(spark, "z", "z"), "key").collect()


def test_many_loads_fold_and_empty_loads_commit_nothing(spark, path, monkeypatch):
    from tallyhouse.sources import keymap

    monkeypatch.setattr(keymap, "_FOLDERS", 2)
    store = KeyMap(spark, path)
    expected = {}
    for i in range(5):
        names = [f"m{j}" for j in range(i + 1)]
        got = {n: k for k, n in keys(store.keyed(members(spark, *names), "key"))}
        assert {n: got[n] for n in expected} == expected
        expected = got
    before = CommitLog(spark, f"{path}/_log").last()
    assert keys(store.keyed(members(spark), "key")) == []
    assert CommitLog(spark, f"{path}/_log").last() == before and store.size() == 5


def test_load_that_loses_the_race_looks_again(spark, path, monkeypatch):
    store, other = KeyMap(spark, path), KeyMap(spark, path)
    commit, done = CommitLog.commit, []

    def slow(self, base, entry):
        if not done:
            done.append(1)
            other.keyed(members(spark, "b", "z"), "key")
        return commit(self, base, entry)

    monkeypatch.setattr(CommitLog, "commit", slow)
    got = keys(store.keyed(members(spark, "a", "b"), "key"))
    both = keys(store.keyed(members(spark, "a", "b", "z"), "key"))
    assert set(got) < set(both) and sorted(k for k, _ in both) == [1, 2, 3]


def test_dimension_with_kept_keys(spark, path):
    rows = [(f"s{i}", "city", "ST", "1") for i in range(4)]
    schema = "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix string"
    first = {r.seller_id: r.store_pk for r in build_dim_store(spark.createDataFrame(rows[:3], schema), KeyMap(spark, path).keyed).collect()}
    second = {r.seller_id: r.store_pk for r in build_dim_store(spark.createDataFrame(rows, schema), KeyMap(spark, path).keyed).collect()}
    assert first["-1"] == -1 and second == first | {"s3": 4}


# --- merging -----------------------------------------------------------------------------------

SCHEMA = "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string"


def orders(spark, *rows):
    full = [(i, c, s, *[f"2020-01-{d:02d} 10:00:00" if d else "" for d in days], "") for i, c, s, *days in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([("c1", 1), ("c2", 2), ("-1", -1)], "customer_id string, customer_pk long")


def shown(snapshot):
    return {r.order_id: (r.customer_fk, r.order_date_fk, r.delivered_date_fk, r.order_status, r.days_to_ship) for r in snapshot.read().collect()}


def test_a_merge_writes_only_the_buckets_it_touches(spark, path, customers):
    snapshot = FulfilmentSnapshot(spark, path, buckets=16)
    snapshot.merge(orders(spark, *[(f"o{i}", "c1", "approved", 1, 2, 0, 0) for i in range(200)]), customers, 0)
    before = snapshot.table.folders()
    assert len(before) == 16
    snapshot.merge(orders(spark, ("o7", "c1", "delivered", 0, 0, 5, 9), ("new", "c2", "created", 3, 0, 0, 0)), customers, 1)
    after = snapshot.table.folders()
    rewritten = [b for b in after if before[b] != after[b]]
    touched = spark.createDataFrame([("o7",), ("new",)], "order_id string").select(F.pmod(F.xxhash64("order_id"), F.lit(16)).alias("b"))
    assert sorted(rewritten) == sorted({r.b for r in touched.collect()})
    got = shown(snapshot)
    assert len(got) == 201
    assert got["o7"] == (1, 20200101, 20200109, "delivered", 3) and got["o8"] == (1, 20200101, 19000101, "approved", None)
    assert got["new"] == (2, 20200103, 19000101, "created", None)


def test_repeated_late_and_empty_batches(spark, path, customers):
    first = orders(spark, ("o", "c1", "shipped", 1, 2, 3, 0), ("o", "c1", "shipped", 1, 2, 3, 0), (None, "c2", "created", 1, 0, 0, 0))
    later = orders(spark, ("o", "c2", "approved", 0, 2, 0, 0), ("p", "nobody", "created", 4, 0, 0, 0))
    snapshot = FulfilmentSnapshot(spark, path, buckets=4)
    for number, batch in enumerate((first, later, first, orders(spark))):
        snapshot.merge(batch, customers, number if number < 2 else 0)
    assert shown(snapshot) == {
        "o": (2, 20200101, 19000101, "shipped", 1),
        None: (2, 20200101, 19000101, "created", None),
        "p": (-1, 20200104, 19000101, "created", None),
    }


def test_two_mergers_lose_nothing(spark, path, customers, monkeypatch):
    one, two = (FulfilmentSnapshot(spark, path, buckets=2) for _ in range(2))
    one.merge(orders(spark, ("o", "c1", "created", 1, 0, 0, 0)), customers, 0)
    commit, done = CommitLog.commit, []

    def slow(self, base, entry):
        if not done:
            done.append(1)
            two.merge(orders(spark, ("o", "c1", "delivered", 0, 0, 5, 6)), customers, 2)
        return commit(self, base, entry)

    monkeypatch.setattr(CommitLog, "commit", slow)
    one.merge(orders(spark, ("o", "c1", "approved", 0, 2, 0, 0)), customers, 1)
    assert shown(one) == {"o": (1, 20200101, 20200106, "delivered", 3)}


def test_readers_keep_their_version_and_cleaning_keeps_two(spark, path, customers):
    snapshot = FulfilmentSnapshot(spark, path, buckets=1)
    for number in range(4):
        snapshot.merge(orders(spark, (f"o{number}", "c1", "created", 1, 0, 0, 0)), customers, number)
        if number == 2:
            early = snapshot.read()
    gone = snapshot.table.clean_up()
    assert len(gone) == 2 and early.count() == 3 and snapshot.read().count() == 4
    assert isinstance(snapshot.table, MergedTable) and snapshot.table.version() == 3


def test_stream_into_the_snapshot(spark, path, customers):
    snapshot = FulfilmentSnapshot(spark, f"{path}/snapshot", buckets=4)
    for batch in (orders(spark, ("o", "c1", "created", 1, 0, 0, 0)), orders(spark, ("o", "c1", "delivered", 0, 2, 3, 4))):
        batch.write.mode("append").parquet(f"{path}/orders")
        snapshot.follow(f"{path}/orders", customers, f"{path}/checkpoint").awaitTermination()
    assert shown(snapshot) == {"o": (1, 20200101, 20200104, "delivered", 1)}
