import math
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import topk


def by_force(rows, k=5):
    usable = [
        (n, i, [math.floor(256 * x) for x in v])
        for n, (i, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v in usable:
        if i is None or i % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), math.inf if j is None else j) for m, j, w in usable if m != n]
        out += [(i, r, None if j == math.inf else j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return sorted((tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, **options).collect()), key=repr)


def test_equal_to_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "_CANDIDATES", 64)
    monkeypatch.setattr(topk, "_QUERIES", 4)
    rng = random.Random(7)

    def value():
        return rng.choice((0.0, 0.25, -0.5, 1.5, -1 / 256, 0.3, 3.75))

    rows = [(i, [value() for _ in range(6)]) for i in range(700)]
    rows += [(700, None), (750, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (800, [float("nan")] * 6), (850, [float("inf")] * 6), (None, [3.75] * 6)]
    rows += [(900, [1.5] * 6)] * 3 + [(901, [1.5] * 6)] * 3 + [(950, [])]
    assert run(spark, rows) == by_force(rows)
    assert run(spark, rows, pivots=2, pivot_sample=1) == by_force(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + 3 * i), float(2**20 - i), 2.0**-4 * i]) for i in range(60)]
    assert run(spark, rows) == by_force(rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(50 * i, [1.0, 2.0]) for i in range(n)]
    assert run(spark, rows) == by_force(rows)


def test_sample_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_force(rows)


def test_blocks_of_queries_do_not_pass_the_driver(spark):
    """Their estimate is small, as it is made before they are repeated."""
    blocks = spark.range(3).selectExpr(
        "id AS block", "array(id) AS rows", "array(id) AS ids", "cast(id AS string) AS v"
    ).selectExpr("block", "rows", "ids", "cast(v AS binary) AS vectors", "cast(v AS binary) AS pivot_table")
    met = topk._meet(blocks, blocks, 2)
    assert met.count() == 9
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [0, 50, 20_000])
def test_few_rows_are_asked_for_the_sample(spark, rows):
    source = spark.range(0, rows, 1, 16).select(F.col("id").alias("row"))
    order = F.xxhash64("row"), "row"
    likely = topk._likely(source, rows, 20)
    assert likely.count() <= min(rows, 400)  # of 16 tasks that would send 20 each
    assert likely.orderBy(*order).limit(20).collect() == source.orderBy(*order).limit(20).collect()
