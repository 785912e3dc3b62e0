import math
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import packing, tokens
from tallyhouse.llm.common import slices, text_buffer
from tallyhouse.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(1)
    parts = ["'s", "'t", "'re", "'ll", "'ve", "'d", "'m", "'", " ", "  ", "\n", "\t", " ", "　", "é", "漢", "٣", "²"]
    parts += ["a", "S", "the", "1", "12", "!", "''", "​", "😀", "\r\n", "'S", "’s", "<|endoftext|>", "\x85", "\x1c", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, "x" * 5000]
    data, offsets = text_buffer(pa.array(texts))
    encoder = Encoder(PATH)
    got = [x for i, j in slices(offsets, 4000) for x in encoder.encode(data, offsets[i : j + 1])]
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_cut_only_longer_documents():
    assert packing.piece_lengths(1, 8) == [1]
    assert packing.piece_lengths(8, 8) == [8]
    assert packing.piece_lengths(9, 8) == [1, 8]
    assert packing.piece_lengths(24, 8) == [8, 8, 8]
    assert packing.piece_lengths(27, 8) == [3, 8, 8, 8]


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # fits both, bin 1 exactly
    assert bins.place(5) == (2, 0)
    assert bins.place(9) == (3, 0)  # bin 0, with 4 left, is the fullest and closes
    assert bins.place(5) == (2, 5)
    assert bins.place(4) == (4, 0)


def check(spark, docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    by_doc, by_sequence, tokens = defaultdict(list), defaultdict(list), 0
    packed = packing.pack_documents(docs, PATH, with_ids=True)
    for r in packed.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        tokens += len(ids)
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (r.length == 2048 or k == 0)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes()) and r.ids == ids[at : at + r.length].tolist()
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_sequence) <= math.ceil(tokens / 2048) * 1.05 + 1
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == tokens


def test_sample_documents(spark, tokenizer):
    check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), tokenizer)


def test_nulls_long_texts_and_other_columns(spark, tokenizer):
    rows = [(1, None, 1), (2, "", 1), (3, "word " * 30_000, 1), (4, "x", 1)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, piece int"), tokenizer)


@pytest.mark.parametrize("n", [0, 3])
def test_repeated_rows_and_empty_tables(spark, n):
    docs = spark.createDataFrame([(None, "a b")] * n, "doc_id long, text string")
    assert packing.pack_documents(docs, PATH).count() == n


def test_the_table_of_classes_takes_little_memory():
    """A worker builds it when it starts, beside all that its executor holds."""
    tokens.process_memo().pop("classes", None)
    tracemalloc.start()
    try:
        table = tokens._classes()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40_000_000 and len(table) == 0x110000
    assert [int(table[ord(c)]) for c in "aé7½  .\U0001f600"] == [1, 1, 2, 2, 3, 3, 4, 4]
