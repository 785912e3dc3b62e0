import random
import re
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def letters():
    """The usual byte-to-letter table of byte-level vocabularies."""
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(0xA1, 0xAC + 1)) + list(range(0xAE, 0xFF + 1))
    out, n = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return {c: b for b, c in out.items()}


def by_force(texts):
    a, b, byte = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), letters()
    a.encode_special_tokens = True
    found = []
    for text in texts:
        if not text:
            found.append(None)
            continue
        wanted = (" " + text).encode()
        one = a.encode(" " + text, add_special_tokens=False)
        ids = one.ids
        bytes_a = [bytes(byte[c] for c in t) for t in one.tokens]
        two = b.encode(text, num_threads=1)
        bytes_b = []
        for i in two:
            piece = b.id_to_piece(i)
            hexed = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            bytes_b.append(bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode())
        if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
            found.append(None)
            continue

        def spans(parts):
            at = 0
            for part in parts:
                yield at, at + len(part)
                at += len(part)

        sa, sb = list(spans(bytes_a)), list(spans(bytes_b))
        links, j = [], 0
        for i, (x, y) in enumerate(sa):
            while sb[j][1] <= x:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < y:
                links.append((ids[i], two[k]))
                k += 1
        ends = sorted({y for _, y in sa} & {y for _, y in sb})
        groups, i, j = [], 0, 0
        for end in ends:
            left, right = [], []
            while i < len(sa) and sa[i][1] <= end:
                left.append(ids[i])
                i += 1
            while j < len(sb) and sb[j][1] <= end:
                right.append(two[j])
                j += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
        found.append((len(sa), len(sb), len(groups), links, sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for f in found if f for p in set(f[3]))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    return [
        (0,) * 6 + ("",) if f is None else (*f[:3], len(f[3]), sum(counts[p] == most[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), f[4])
        for f in found
    ]


def run(spark, texts):
    rows = [(i, t, i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, pairs string")
    got = sorted(tuple(r) for r in align.report(docs, A, B).collect())
    assert [r[0] for r in got] == list(range(len(texts)))
    return [r[1:] for r in got]


ODD = [
    None, "", " ", "  ", "a", "\n", "x ", "  two  spaces  ", "<|endoftext|> </s> <0x41> <s>", "▁ mark", "a▁b", "é你😀z ①② \U0001f9d1‍\U0001f680",
    "\x00\x01\t\r\n", "näive Å ﬁ　x", "ÄÖÜß straße", "日本語のテキスト。", "don't I'll we've 'S", "it 's   x\n\n  y", "한국어 עברית العربية", "﻿�",
]


def test_equal_to_brute_force(spark):
    rng = random.Random(5)
    alphabet = list("ab éx'st1 \n\t.你😀①ß") + ["the ", " and", "ing", "  "]
    texts = ODD + ["".join(rng.choice(alphabet + ["▁"] * (i % 5 == 0)) for _ in range(rng.randint(1, 60))) for i in range(400)]
    texts += ["same text here"] * 5 + [None] * 2
    expected = by_force(texts)
    assert sum(e[0] == 0 for e in expected) > 10 and sum(e[0] > 0 for e in expected) > 200
    assert run(spark, texts) == expected


def test_very_long_texts(spark):
    texts = ["word é " * 60_000, "x" * 5_000, "ends with spaces" + " " * 3_000]
    assert run(spark, texts) == by_force(texts)


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    expected = by_force([r.text for r in rows])
    got = {r.doc_id: tuple(r)[1:] for r in align.report(docs, A, B).collect()}
    assert got == {r.doc_id: e for r, e in zip(rows, expected, strict=True)}


def test_spans_are_places_of_the_text(spark):
    texts = ["é你 the café", None, "plain text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, _ = align.aligned(docs, A, B, with_spans=True)
    for r in found.collect():
        size = len((" " + texts[r.doc_id]).encode()) if texts[r.doc_id] else 0
        for ids, ends in ((r.a_ids, r.a_ends), (r.b_ids, r.b_ends)):
            assert len(ids) == len(ends) and ends == sorted(set(ends)) and (ends[-1] if ends else 0) == size


def test_rules_hold_only_for_files_that_promise_them(tmp_path):
    assert align.ByteLevel(A).splits and align.SentencePiece(B).splits
    other = tmp_path / "other.json"
    other.write_text(open(A, encoding="utf-8").read().replace('"use_regex": true', '"use_regex": false').replace('"use_regex":true', '"use_regex":false'), encoding="utf-8")
    assert not align.ByteLevel(str(other)).splits


@pytest.mark.parametrize("texts", [[], [None], ["▁"]])
def test_tables_without_tokens(spark, texts):
    assert run(spark, texts) == [(0,) * 6 + ("",)] * len(texts)


def test_forgetting_changes_nothing(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tallyhouse.llm.common import text_buffer

    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abc é") for _ in range(4)) for _ in range(30)) for _ in range(60)]
    expected = by_force(texts)
    monkeypatch.setattr(align, "_REMEMBERED", 200)
    a, b = align.Remembered(align.ByteLevel(A)), align.Remembered(align.SentencePiece(B))
    for i in range(0, 60, 3):
        found = align.Aligned(a, b, *text_buffer(pa.array(texts[i : i + 3])))
        assert found.written() == [e[6] for e in expected[i : i + 3]]
        assert np.array(found.counts()).T.tolist() == [list(e[:4]) for e in expected[i : i + 3]]
