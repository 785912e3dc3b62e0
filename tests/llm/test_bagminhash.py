import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import bagminhash
from tallyhouse.llm.common import text_buffer
from tallyhouse.llm.linking import components, link


def bag(text):
    words = (text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def classes_by_force(texts):
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = bags[i], bags[j]
            if find(i) == find(j) or min(a.total(), b.total()) * 5 < max(a.total(), b.total()) * 4:
                continue
            common = (a & b).total()
            if common * 5 >= (a.total() + b.total() - common) * 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, class_id string, row int")
    got = {r.doc_id: r for r in bagminhash.near_duplicates(docs)[1].collect()}
    want = classes_by_force(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    sizes = Counter(want)
    assert all(got[i].class_size == sizes[want[i]] for i in got)
    assert sorted(i for i in got if got[i].is_first) == sorted(set(want))


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(10):
        f = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
        a, b = rng.integers(0, 40, 50), rng.integers(0, 40, 50)
        b = np.where(rng.random(50) < 0.6, a, b)
        text = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        best = bagminhash.signatures(text, np.concatenate([f[a > 0], f[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 4096)
        errors.append((best[0] == best[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.02


def test_signature_does_not_depend_on_the_batch():
    texts = ["a", "a b c d e f g", "x y " * 300, "one two three four five six " * 2, ""]
    data, offsets = text_buffer(pa.array(texts))
    whole = bagminhash.signatures(*bagminhash.shingle_counts(data, offsets), len(texts), 64)
    for i, t in enumerate(texts):
        data, offsets = text_buffer(pa.array([t]))
        alone = bagminhash.signatures(*bagminhash.shingle_counts(data, offsets), 1, 64)
        assert (alone[0] == whole[i]).all()


def test_classes_equal_brute_force_on_clouds_of_copies(spark):
    rng = random.Random(3)
    texts = [None, "", "  \n", "one", "one ", "a b c", "a b  c"]
    for size, copies in ((30, 12), (120, 60), (400, 10)):
        words = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for _ in range(copies):
            edited = list(words)
            for _ in range(rng.randrange(1 + size // 25)):
                edited[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(edited))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    texts += texts[10:16]
    check(spark, texts)


def test_sample_documents(spark):
    check(spark, [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()])


def test_open_buckets_lose_no_link(spark):
    """A chain in one bucket, of which no leader sees all links."""
    members = spark.createDataFrame([(1, i) for i in range(40)], "key long, id long")

    def near(pairs):
        return pairs.where("abs(a - b) = 1").select("a", "b")

    def rest(still):
        x, y = still.alias("x"), still.alias("y")
        return near(x.join(y, "key").where("x.comp < y.comp").selectExpr("x.id a", "y.id b").distinct())

    labels = link(members, near, rest)
    assert labels.count() == 40 and labels.select("comp").distinct().count() == 1


def test_rest_compares_across_blocks(spark):
    texts = [" ".join(f"w{i}" for i in range(100)) + f" z{k}" for k in range(30)]
    rows = spark.createDataFrame([(7, i, i, t) for i, t in enumerate(texts)], "key long, id long, comp long, text string")
    found = bagminhash._all_links(bagminhash._chooser(rows.selectExpr("id row", "text")), 500)(rows.select("key", "id", "comp"))
    assert components(found).select("comp").distinct().count() == 1


@pytest.mark.parametrize("n", [0, 3])
def test_repeated_rows_and_empty_tables(spark, n):
    docs = spark.createDataFrame([(None, "a b c d e f", "s", 1)] * n, "doc_id long, text string, source string, _row int")
    assert bagminhash.near_duplicates(docs)[1].count() == n
    kept = bagminhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == min(n, 1)
