import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tallyhouse.llm import spelling


def edits(a, b):
    """Whether one inserted, deleted or replaced letter parts two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, slips):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def by_force(words, ratio=5):
    out = {}
    masks = {}
    for w in words:
        for i in range(len(w) + 1):
            masks.setdefault((w[:i], w[i + 1 :]), set()).add(w)
            masks.setdefault((w[:i], w[i:]), set()).add(w)
    for w, n in words.items():
        met = set().union(*[masks[k] for i in range(len(w) + 1) for k in ((w[:i], w[i + 1 :]), (w[:i], w[i:]))])
        near = [v for v in met if edits(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = [form, None, n, len(near), None if form is None else words[form]]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = spelling.spelling_groups(docs, **options).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@pytest.mark.parametrize("slice_words", [3, 4096])
def test_equal_to_brute_force(spark, slice_words):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(200)]
        words += [w for w in words[:20] for _ in range(rng.choice((1, 8, 40)))]
        rows.append((i, " ".join(words)))
    rows += [(None, "Aaaaaab1aaaaaab× ÀAAAAAB aaaaaab"), (7, None), (8, ""), (9, "x" * 50_000), rows[0], rows[0]]
    expected = by_force(counted(rows, 5))
    assert len(expected) > 300 and any(v[0] for v in expected.values()) and any(v[3] > 5 for v in expected.values())
    assert run(spark, rows, slips=5, slice_words=slice_words) == expected


def test_chains_lead_to_their_last_form(spark):
    counts = {"aaaaaa": 3125, "aaaaab": 625, "aaaabb": 125, "aaabbb": 25, "aabbbb": 5, "zzzzzz": 5}
    rows = [(1, " ".join(" ".join([w] * n) for w, n in counts.items()))]
    got = run(spark, rows)
    assert got == by_force(counts)
    assert got["aabbbb"][:2] == ("aaabbb", "aaaaaa") and got["zzzzzz"][:2] == (None, "zzzzzz")


def test_ties_go_to_the_smallest_word(spark):
    got = run(spark, [(1, "abcdef " * 5 + "abcdeé " * 50 + "abcdez " * 50)])
    assert got["abcdef"] == ("abcdez", "abcdez", 5, 2, 50)


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = by_force(counted([(r.doc_id, r.text) for r in docs.collect()], 199))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(docs, slips=199).collect()}
    assert got == expected and any(v[0] for v in expected.values())


def test_empty_table(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, "short words only")]) == {}
