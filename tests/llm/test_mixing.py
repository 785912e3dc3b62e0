import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import mixing


def corpus(spark):
    rows, i = [], 0
    for source, docs in (("big", 300), ("mid", 60), ("small", 20), (None, 10)):
        for k in range(docs):
            rows.append((i, "w " * (5 + (k * 7) % 23), source))
            i += 1
    rows += [(i, None, "big"), (i + 1, " \n", "small"), (i + 2, "", "blank")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def weights(rows, exponent):
    total = Counter()
    for _, t, s in rows:
        total[s] += len((t or "").split())
    total = {s: n for s, n in total.items() if n}
    z = sum((n / sum(total.values())) ** exponent for n in total.values())
    return total, {s: (n / sum(total.values())) ** exponent / z for s, n in total.items()}


def test_repetition_limit(spark):
    docs, rows = corpus(spark)
    _, places, _ = mixing.mixture(docs, max_repeats=3.0, block_tokens=200)
    got = places.collect()
    times = Counter(r.doc_id for r in got)
    assert set(times) == {r[0] for r in rows}
    assert all(1 <= n <= 3 for n in times.values())
    assert all(times[r[0]] == 1 for r in rows if r[2] == "big" or not (r[1] or "").strip())
    total, _ = weights(rows, 1.0)
    used = Counter()
    for r in got:
        used[r.source] += r.tokens
    for s in total:
        budget = 3.0 * total[s] if s is None else None
        if budget:
            assert budget * 0.99 - 30 <= used[s] <= budget + 1
    assert len({(r.doc_id, r.epoch) for r in got}) == len(got)
    for s in total:
        order = sorted((r for r in got if r.source == s and r.tokens), key=lambda r: r.position)
        assert [r.epoch for r in order] == sorted(r.epoch for r in order)
        by_block = defaultdict(list)
        for n, r in enumerate(order):
            by_block[r.epoch, r.block].append(n)
        assert all(v == list(range(v[0], v[-1] + 1)) for v in by_block.values())  # a block is read at one go
    first, second = ([r.doc_id for r in sorted(got, key=lambda r: r.position) if r.source is None and r.epoch == e and r.tokens] for e in (0, 1))
    assert set(first) == set(second) and first != second


def test_target_entropy_and_budget(spark):
    docs, rows = corpus(spark)
    _, places, _ = mixing.mixture(docs, target_entropy=1.2, max_repeats=None, budget=2000, block_tokens=100)
    total, flat = weights(rows, 0.0)
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        w = weights(rows, mid)[1]
        low, high = (mid, high) if -sum(x * math.log(x) for x in w.values()) >= 1.2 else (low, mid)
    want = weights(rows, low)[1]
    used = Counter()
    for r in places.collect():
        if r.tokens:
            used[r.source] += r.tokens
            assert abs(r.weight - want[r.source]) < 1e-4
    for s in want:
        assert want[s] * 2000 - 30 <= used[s] <= want[s] * 2000 + 1


@pytest.mark.parametrize("n", [0, 1, 3])
def test_repeated_rows_one_source_and_empty_tables(spark, n):
    docs = spark.createDataFrame([(None, "a b c", "s", 1, "e")] * n, "doc_id long, text string, source string, epoch int, _epochs string")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == n


def test_only_built_in_functions(spark):
    docs, _ = corpus(spark)
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_budget_far_beyond_a_small_source(spark):
    tokens = spark.createDataFrame([("a", 3), ("b", 4)], "s string, tokens long")
    got = {r.s: r for r in mixing.source_weights(tokens, target_entropy=0.69, budget=10**11).collect()}
    assert all(r.epochs == r.budget // r.total > 2**31 for r in got.values())
    assert abs(sum(r.budget for r in got.values()) - 10**11) <= 1


def test_epochs_come_in_ranges(spark, monkeypatch):
    rows = [(i, "w " * (i % 5 + 1), "ab"[i % 2]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    _, whole, _ = mixing.mixture(docs, budget=1000)
    want = sorted(whole.collect(), key=str)
    monkeypatch.setattr(mixing, "EPOCH_RANGE", 3)
    _, cut, _ = mixing.mixture(docs, budget=1000)
    assert sorted(cut.collect(), key=str) == want and max(r.epoch for r in want) > 9


def test_blocks_start_where_one_running_sum_puts_them(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_BITS", 3)  # ranges of many blocks, as large sources have
    rng = random.Random(5)
    blocks = [(s, b, rng.randint(1, 9), s == "a") for s, n in (("a", 200), ("b", 3), ("", 1)) for b in range(n)]
    table = spark.createDataFrame(blocks, "s string, block long, tokens long, twice boolean")
    total = table.groupBy("s").agg(F.sum("tokens").alias("total"))
    by_block = table.join(total, "s").select("s", "block", "tokens", "total", F.when(F.col("twice"), 2).otherwise(0).cast("long").alias("epochs"))
    got = {(r.s, r.block, r.epoch): r.block_start for r in mixing._block_starts(by_block, 7).collect()}
    each = by_block.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "epochs")).alias("epoch"))
    rows = each.withColumn("place", F.xxhash64("s", "block", "epoch", F.lit(7))).collect()
    want, so_far = {}, {}
    for r in sorted(rows, key=lambda r: (r.s, r.epoch, r.place, r.block)):
        key = (r.s, r.epoch)
        want[r.s, r.block, r.epoch] = r.epoch * r.total + so_far.get(key, 0)
        so_far[key] = so_far.get(key, 0) + r.tokens
    assert got == want and len(want) == 3 * 200 + 3 + 1


def test_null_and_long_texts_ties_and_clashing_columns(spark):
    rows = [(1, "a", "w " * 300_000, 1, "x"), (1, "a", "w " * 300_000, 1, "x"), (None, None, None, None, None), (2, "a", "", 2, "y"), (3, "b", "one two", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, epoch int, weight string")
    got = mixing.mixed_documents(docs, max_repeats=1.0).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)
    assert mixing.mixed_documents(docs.limit(0)).columns == docs.columns
