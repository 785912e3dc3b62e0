import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import sharding


def run(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, shard string, row int")
    got = {r.doc_id: r for r in sharding.shard_documents(docs.repartition(5), **options).collect()}
    assert len(got) == len(texts)
    slots = defaultdict(list)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(raw) + 16, crc32(raw), "bytes", None)
        assert got[i].n_tokens == len((text or "").split())
        slots[got[i].shard].append(got[i].slot)
    for shard, taken in slots.items():
        assert 0 <= shard < options.get("shards", 40) and sorted(taken) == list(range(len(taken)))
    return got


def spread(got, value, shards):
    sums = np.zeros(shards)
    for r in got.values():
        sums[r.shard] += value(r)
    return sums.max() / sums.mean() - 1, 1 - sums.min() / sums.mean()


def test_all_measures_are_balanced_and_copies_stay_together(spark):
    rng = random.Random(1)
    texts = [" ".join("w" * rng.randint(1, 9) for _ in range(int(rng.paretovariate(1.2)) + 3)) for _ in range(6000)]
    texts += [f"copied text {i % 200} of a group" for i in range(1000)]
    got = run(spark, texts, shards=8)
    for value in (lambda r: r.size, lambda r: r.n_tokens, lambda r: 1):
        assert max(spread(got, value, 8)) < 0.01
    of = defaultdict(set)
    for i, text in enumerate(texts):
        of[text].add(got[i].shard)
    assert all(len(s) == 1 for text, s in of.items() if text.startswith("copied"))


def test_a_third_of_all_rows_is_one_group(spark):
    texts = ["same text"] * 3000 + [f"text number {i} " * (i % 7 + 1) for i in range(6000)] + [None, ""] * 20
    got = run(spark, texts)
    assert max(spread(got, lambda r: r.size, 40)) < 0.02 and max(spread(got, lambda r: 1, 40)) < 0.15
    assert len({got[i].shard for i in range(3000)}) <= 54
    assert len({got[i].shard for i in range(9000, 9040)}) == 1


def test_very_long_texts_get_room(spark):
    texts = ["long word " * 20_000] * 2 + ["short one here"] * 10 + [f"some other {i} text" for i in range(2000)]
    got = run(spark, texts, shards=4)
    assert got[0].shard != got[1].shard


@pytest.mark.parametrize("tasks", [1, 50])
def test_placing_equals_a_plain_loop(spark, monkeypatch, tasks):
    monkeypatch.setattr(sharding, "_PER_TASK", 10_000 // tasks)
    monkeypatch.setattr(sharding, "LARGE", 1.0)
    rng = random.Random(4)
    rows = [(i, i * 7, 0, rng.randint(17, 900), rng.randint(0, 150), rng.randint(1, 3)) for i in range(3000)]
    units = spark.createDataFrame(rows, "h1 long, h2 long, piece int, bytes long, tokens long, rows long")
    totals = np.array(rows, float)[:, 3:].sum(axis=0)
    got = {r.h1: r.shard for r in sharding.placed_groups(units, totals, 5).collect()}
    sums = np.zeros((5, 3))
    for r in rows:
        sums[got[r[0]]] += r[3:]
    assert (np.abs(sums / sums.mean(axis=0) - 1) < (0.01 if tasks == 1 else 0.1)).all()
    if tasks == 1:

        def dot(a, b):
            return sum(w * x * y for w, x, y in zip(sharding.WEIGHTS, a, b, strict=True))

        left = [[x / 5 for x in (1.0, 1.0, 1.0)] for _ in range(5)]
        for r in sorted(rows, key=lambda r: (-max(r[3 + k] / totals[k] for k in range(3)), r[:3])):
            v = [r[3 + k] / totals[k] for k in range(3)]
            best = max(range(5), key=lambda s: (round(dot(left[s], v), 15), -s))
            worth = [dot(left[s], v) for s in (best, got[r[0]])]
            assert abs(worth[0] - worth[1]) < 1e-12
            for k in range(3):
                left[got[r[0]]][k] -= v[k]


@pytest.mark.parametrize("texts", [[], [None], ["a", "a", None, ""]])
def test_few_rows(spark, texts):
    run(spark, texts)


def test_tokens_may_be_counted_otherwise(spark):
    docs = spark.createDataFrame([(1, "a b", 7), (2, "c", None)], "doc_id long, text string, n int")
    got = sharding.shard_documents(docs, tokens=F.col("n"))
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {1: 7, 2: 0}
    assert sum(r.rows for r in sharding.shard_sizes(got).collect()) == 2


def test_same_rows_same_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, again = (sorted(tuple(r) for r in sharding.shard_documents(docs).collect()) for _ in range(2))
    assert first == again
    sizes = np.array([r["bytes"] for r in sharding.shard_sizes(sharding.shard_documents(docs)).collect()])
    assert len(sizes) == 40 and sizes.max() < 1.05 * sizes.mean()
