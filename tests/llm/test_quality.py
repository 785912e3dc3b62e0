import re
from collections import Counter

import pytest

from tallyhouse.llm.quality import clean_documents, quality_report

PROSE = " ".join(f"alpha{i}, beta{i} and gamma{i}." for i in range(20))
TEXTS = [
    None,
    "",
    " \n\t\n",
    PROSE,
    PROSE + "\nhome | about | contact | login",
    PROSE + "\nBUY!! NOW!! CHEAP!! OFFER!!\nClick here to win",
    "\n".join(["one | two | three | four | five"] * 12),
    "a b c " * 40,
    "x " * 200_000,
    " ".join(f"w{i}" for i in range(60)),
    "é ü 漢字 #1 $2 <b> & | % *\n" * 8,
    "same line here.\nsame line here.\n\nsame line here. \n" + PROSE,
]


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


def test_base_measures_equal_a_plain_count(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = quality_report(docs).orderBy("doc_id").collect()
    for row, text in zip(got, TEXTS, strict=True):
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == base(text)
        assert not (row.base_failed and row.kept)


def test_lines_fail_by_rule_and_documents_by_loss(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in clean_documents(docs).collect()}
    assert kept[3] == PROSE
    assert kept[4] == PROSE
    assert kept[5] == PROSE
    assert 6 not in kept and 9 not in kept  # separators; no punctuation at all
    assert kept[11] == TEXTS[11]


@pytest.mark.parametrize("n", [0, 3])
def test_other_columns_repeated_rows_and_empty_tables(spark, n):
    rows = [(None, PROSE, "a", 1.0)] * n
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string, kept double")
    out = clean_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == n
    assert quality_report(docs).count() == n


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality_report(docs).join(labels, "doc_id", "left").collect()
    for row in rows:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == base(texts[row.doc_id])
        if row.quality == 0:
            assert not row.kept
        if row.quality == 1 and not row.base_failed:
            assert row.kept
