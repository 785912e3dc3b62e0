import random
import re
from hashlib import sha256

import pytest

from tallyhouse.llm import pii

CARDS = "4111111111111111"


def by_force(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def written(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_rules_equal_plain_patterns():
    rng = random.Random(1)
    for alphabet in ("aB1234567890..@@--+  ()_%é\n", "4512 -.+1", "a.@b-"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70)))
            assert pii.rule_spans(text) == by_force(text)


def test_rules_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "1-" * 150_000):
        pii.units(text, pii.rule_spans(text))


def test_patterns_find_what_no_rule_knows(spark):
    rng = random.Random(2)
    texts = [f"Please write to mail address me{i}@x.example.com for more {i % 7}." for i in range(20)]
    texts += ["you may write to mail address john.doe(at)home42 for more."] * 3
    texts += [f"the room {rng.randrange(10**8)} of {w} house" for w in ("this", "that", "my") for _ in range(20)]
    texts += [None, "", "no digits here", f"card {CARDS} and 10.0.0.1 or +1 (234) 555-7586"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        spans = by_force(text or "")
        assert got[i].base_sha256 == sha256(written(spans).encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        if 20 <= i < 23:
            at = text.index("john")
            assert got[i].spans == f"email:{at}:{at + len('john.doe(at)home42')}"
        else:
            assert got[i].spans == written(spans)


def test_counts_and_digests_of_the_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = pii.report(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        spans = by_force(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == sha256(written(spans).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 3])
def test_repeated_rows_and_empty_tables(spark, n):
    docs = spark.createDataFrame([(None, "a@b.de")] * n, "doc_id long, text string")
    assert [r.spans for r in pii.report(docs).collect()] == ["email:0:6"] * n
