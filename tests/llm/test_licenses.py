import random
import re

import pytest

from tallyhouse.llm import licenses


def base(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += here
        if here:
            labels.add(label)
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


NOISE = " ".join(f"word{i} the of and" for i in range(50))
TEXTS = {
    "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "Released under the MIT License.": "mit",
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
    "All rights reserved.": "all-rights-reserved",
    "the apache tribe has a license to version itself": "",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction": "mit-notice",
}


def test_base_equals_a_plain_search(spark):
    rng = random.Random(4)
    texts = [None, "", "é" * 10, "MIT\nLicense mit license GNU general-public license"]
    pool = "gnu general public license apache cc by mit É x1 - . \n GNU".split(" ")
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts.append("mit license " * 50_000)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    rows = licenses.licence_report(docs).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == base(text)
        assert 0 <= row.score <= 1
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))


def test_notices_are_found_inside_other_text(spark):
    texts = [NOISE + "\n" + t + "\n" + NOISE for t in TEXTS]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = licenses.licence_report(docs).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == list(TEXTS.values())


@pytest.mark.parametrize("n", [0, 3])
def test_repeated_rows_and_empty_tables(spark, n):
    docs = spark.createDataFrame([(None, "mit license")] * n, "doc_id long, text string")
    assert [r.base_labels for r in licenses.licence_report(docs).collect()] == ["mit"] * n


def test_all_notices_of_a_long_text_are_found(spark):
    rng = random.Random(6)
    chosen = [licenses.TEMPLATES] + [rng.sample(licenses.TEMPLATES, rng.randint(2, 18)) for _ in range(40)]
    texts = [NOISE + "".join(f"\n{t}\n{NOISE}" for _, t, _ in rng.sample(some, len(some))) for some in chosen]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = licenses.licence_report(docs).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        plain = {label for label, t, _ in licenses.TEMPLATES if t in text}
        assert plain <= set(row.labels.split(","))
    assert set(rows[0].labels.split(",")) == {t[0] for t in licenses.TEMPLATES} | set(licenses.BASE.values())


def brute(text):
    """Every template at every window, without an index: the notices found."""
    words = licenses.words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = {}
    for label, notice, phrases in licenses.TEMPLATES:
        own = licenses.words_of(notice)
        slack = max(licenses.SHIFT, len(own) // licenses.SLACK)
        step, width = slack + 1, 3 * slack + 1
        begin = -slack - step * ((len(own) + width) // step + 1)
        while begin < len(words):
            low, high = max(0, begin), min(len(words), begin + len(own) + width - 1)
            at = [[i for i in range(low, high - len(p) + 1) if words[i : i + len(p)] == p] for p in (x.split() for x in phrases)]
            if all(at):
                matched = sum(w in words[max(0, begin + i) : max(0, begin + i + width)] for i, w in enumerate(own))
                if matched >= licenses.MIN_SCORE * len(own) - 1e-9:
                    key = (at[0][0], label)
                    found[key] = max(found.get(key, 0), matched / len(own))
            begin += step
    return [(label, at, score) for (at, label), score in sorted(found.items())]


def mutated(rng, text, rate):
    words = licenses.words_of(text)
    pool = words + "the of license software granted version 2 3 noise".split()
    out = []
    for w in words:
        kind = rng.random() / rate if rate else 9
        out += [] if kind < 1 / 3 else [rng.choice(pool)] if kind < 2 / 3 else [w, rng.choice(pool)] if kind < 1 else [w]
    return " ".join(out)


def test_the_index_finds_what_a_plain_search_finds(spark):
    rng = random.Random(11)
    texts = [None, "", "cc0", "all rights reserved " * 40]
    for _ in range(120):
        some = rng.sample(licenses.TEMPLATES, rng.randint(1, 3))
        filler = NOISE.split()[: rng.randint(0, 30)]
        texts.append(" ".join(filler + [mutated(rng, t, rng.choice([0, 0.05, 0.2, 0.5])) for _, t, _ in some]))
    vocabulary = licenses.words_of(" ".join(t for _, t, _ in licenses.TEMPLATES[:18]))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(400)) for _ in range(5)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = licenses.licence_report(docs).orderBy("doc_id").collect()
    assert sum(len(r.notices) for r in rows) > 100
    for row, text in zip(rows, texts, strict=True):
        expected = brute(text)
        assert [tuple(x) for x in row.notices] == expected
        assert row.score == max([score for _, _, score in expected], default=0)


def test_whole_licence_texts_with_changed_words(spark):
    whole = {label: t for label, t, _ in licenses.TEMPLATES if len(licenses.words_of(t)) > 40}
    assert len(whole) >= 5
    texts = []
    for t in whole.values():
        words = t.split()
        for i in range(20, len(words), 30):  # names put in, as authors do
            words[i] = words[i] + " Example Corp"
        texts.append(NOISE + " Copyright 2020 Example Corp. " + " ".join(words) + " " + NOISE)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = licenses.licence_report(docs).orderBy("doc_id").collect()
    for row, label in zip(rows, whole, strict=True):
        assert label in row.labels.split(",")


def test_looked_up_places_cannot_be_avoided():
    index = licenses.Index()
    rng = random.Random(3)
    for template in index.templates:
        rarity = [rng.choice([-1.0, -2.0, -3.0]) for _ in index.words]
        lookups = template.lookups(rarity)
        others = len(template.words) - len(lookups)
        assert len(set(lookups)) == len(lookups)
        assert template.needed - others >= template.agree or others <= 0
        rest = set(range(len(template.words))) - set(lookups)
        assert not rest or max(rarity[template.words[p]] for p in rest) <= min(rarity[template.words[p]] for p in lookups)


TEXT_AT_THE_END = "this is licensed under the Apache License Version 2.0"


def test_very_long_text_null_ids_and_clashing_columns(spark):
    long = "filler words of no licence " * 200_000 + TEXT_AT_THE_END
    rows = [(None, None, "x", 1), (1, "", None, 2), (2, long, "y", None), (2, long, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, n_words int")
    found = licenses.licence_report(docs).collect()
    assert sorted((r.n_words, r.labels) for r in found) == [(0, ""), (0, ""), (1_000_010, "apache,apache-2.0"), (1_000_010, "apache,apache-2.0")]
