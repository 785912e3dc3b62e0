"""Licence notices by a positional index of rare words.

The templates below, short notices and whole licence texts, are known by word and place. The rarity
(IDF) of a licence word comes from its document frequency over the whole corpus. Each template is
indexed by its rarest places: so many of them that a notice which has enough of the template's words
holds at least two. A text's rare words are looked up in these postings; each hit says where the
template would begin, and the hits are intersected by that relative position. Where enough agree, the
template's mandatory phrases must stand within the region, and then all its words are counted at
their places. The index only spares work: what it finds is every region in which at least
``MIN_SCORE`` of the template's words stand at their places, shifted by at most its slack, together
with the phrases. Neither words nor notices of a text are limited in number.

Null and empty texts have no words. Very long texts are read whole. Equal rarities are ordered by word
and place, which changes no result. Repeated rows are rows of their own. An empty table gives an
empty one. Other columns than ``doc_id`` and ``text`` may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices, text_buffer
from tallyhouse.llm.vector import byte_class, span_hashes, spans

# Phrases and labels of the base rule.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Labels, notices as their licences give them, and the phrases a notice must hold.
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation",
        ["free software", "gnu general public license", "free software foundation"],
    ),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    (
        "apache-notice",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ["in compliance with the license", "obtain a copy of the license"],
    ),
    ("mit", "released under the mit license", ["mit license"]),
    (
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    (
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met",
        ["source and binary forms", "provided that the following conditions are met"],
    ),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee", "hereby granted"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["public domain", "cc0"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY "
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ["permission is hereby granted free of charge", "the software is provided as is"],
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
        ["source and binary forms", "this list of conditions and the following disclaimer"],
    ),
    (
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        ["neither the name of", "endorse or promote products"],
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ["with or without fee", "the author disclaims all warranties"],
    ),
    (
        "zlib-text",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The "
        "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use "
        "this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This "
        "notice may not be removed or altered from any source distribution.",
        ["must not be misrepresented", "permission is granted to anyone to use this software"],
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means.",
        ["free and unencumbered software", "public domain"],
    ),
]

SHIFT = 3  # words that may be missing or added within a short notice
SLACK = 12  # and one more for so many words of a longer one
MIN_SCORE = 0.6  # share of a template's words that must stand at their places
AGREE = 2  # looked-up words that must agree on where a notice begins

_WORD = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


class Template:
    """Words of a notice by number, its mandatory phrases, and how far its words may be shifted.

    A window is a range of ``width`` places at which the template may begin. Windows overlap, so
    that any places up to twice the slack apart fall into one; ``step`` apart they start.
    """

    def __init__(self, label: str, words: list[int], phrases: list[tuple[int, ...]]):
        self.label, self.words, self.phrases = label, words, phrases
        self.slack = max(SHIFT, len(words) // SLACK)
        self.step, self.width = self.slack + 1, 3 * self.slack + 1
        #: Places that must agree, of all places: a share cannot be less than one.
        self.needed = int(np.ceil(MIN_SCORE * len(words) - 1e-9))
        self.agree = min(AGREE, self.needed)

    def begin(self, window: np.ndarray) -> np.ndarray:
        return window * self.step - self.slack

    def lookups(self, rarity: np.ndarray) -> list[int]:
        """The rarest places, so many that ``needed`` places cannot avoid ``agree`` of them."""
        places = sorted(range(len(self.words)), key=lambda p: (-rarity[self.words[p]], self.words[p], p))
        return places[: len(places) - self.needed + self.agree]


class Index:
    """The templates, with words numbered in the order of their hashes."""

    def __init__(self):
        texts = [(label, words_of(text), [p.split() for p in phrases]) for label, text, phrases in TEMPLATES]
        base = [p.split() for p in BASE]
        words = sorted({w for _, t, ps in texts for w in [*t, *sum(ps, [])]} | {w for p in base for w in p})
        data = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        hashes = span_hashes(data, np.append(0, ends[:-1]), ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.words = [words[i] for i in order]
        number = {w: i for i, w in enumerate(self.words)}
        self.templates = [Template(label, [number[w] for w in t], [tuple(number[w] for w in p) for p in ps]) for label, t, ps in texts]
        self.base = [([number[w] for w in p], BASE[" ".join(p)]) for p in (x.split() for x in BASE)]


def word_numbers(data: np.ndarray, offsets: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Of each word its text and its number in the index, or -1."""
    lower = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)
    a, b, text = spans(lower, offsets, _WORD)
    hashes = span_hashes(lower, a, b)
    at = np.minimum(np.searchsorted(index.hashes, hashes), len(index.hashes) - 1)
    return text, np.where(index.hashes[at] == hashes, at, -1)


def phrase_starts(numbers: np.ndarray, text: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Words where the phrase's words stand one after the other within a text."""
    n = len(numbers) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = text[:n] == text[len(phrase) - 1 :]
    for i, w in enumerate(phrase):
        hit &= numbers[i : n + i] == w
    return np.flatnonzero(hit)


def document_frequency(docs: DataFrame) -> dict[str, int]:
    """Of each licence word the number of documents that hold it. Tasks count; what reaches the
    driver is one row per licence word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index()
        total = np.zeros(len(index.words), np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for i, j in slices(offsets):
                text, numbers = word_numbers(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], index)
                known = numbers >= 0
                pairs = np.unique(text[known] * len(index.words) + numbers[known])
                total += np.bincount(pairs % len(index.words), minlength=len(index.words))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([index.words[i] for i in some], pa.string()), pa.array(total[some])], names=["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


class Corpus:
    """The licence words of some texts: of each word its places, in order. Places count over all
    the texts; ``first_of`` has the place at which each text begins."""

    def __init__(self, numbers: np.ndarray, text: np.ndarray, n: int, index: Index):
        self.numbers, self.text = numbers, text
        self.first_of = np.searchsorted(text, np.arange(n + 1))
        known = np.flatnonzero(numbers >= 0)
        self._places = known[np.argsort(numbers[known], kind="stable")]
        self._starts = np.searchsorted(numbers[self._places], np.arange(len(index.words) + 1))
        self._phrases: dict[tuple[int, ...], np.ndarray] = {}

    def places(self, word: int) -> np.ndarray:
        return self._places[self._starts[word] : self._starts[word + 1]]

    def phrase(self, phrase: tuple[int, ...]) -> np.ndarray:
        if phrase not in self._phrases:
            rarest = min(phrase, key=lambda w: len(self.places(w)))
            if len(self.places(rarest)):
                self._phrases[phrase] = phrase_starts(self.numbers, self.text, list(phrase))
            else:
                self._phrases[phrase] = np.zeros(0, np.int64)
        return self._phrases[phrase]


def _candidates(corpus: Corpus, template: Template, lookups: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Texts and windows in which enough of the looked-up words agree on where the template begins."""
    own, windows, places = [], [], []
    for place in lookups:
        at = corpus.places(template.words[place])
        if not len(at):
            continue
        text = corpus.text[at]
        starts = at - corpus.first_of[text] - place
        last = (starts + template.slack) // template.step
        for window in (last, last - 1, last - 2):
            inside = starts < template.begin(window) + template.width
            own.append(text[inside])
            windows.append(window[inside])
            places.append(np.full(int(inside.sum()), place))
    if not own:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    votes = np.stack([np.concatenate(own), np.concatenate(windows), np.concatenate(places)])
    votes = votes[:, np.lexsort(votes[::-1])]
    new = np.append(True, (votes[:, 1:] != votes[:, :-1]).any(axis=0))
    votes = votes[:2, new]  # a word that stands twice near its place votes once
    first = np.flatnonzero(np.append(True, (votes[:, 1:] != votes[:, :-1]).any(axis=0)))
    agreed = first[np.diff(np.append(first, votes.shape[1])) >= template.agree]
    return votes[0, agreed], votes[1, agreed]


def _within(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether one of the sorted places lies in [low, high), and the first that does not lie before."""
    if not len(at):
        return np.zeros(len(low), bool), np.zeros(len(low), np.int64)
    next_one = at[np.minimum(np.searchsorted(at, low), len(at) - 1)]
    return (next_one >= low) & (next_one < high), next_one


def notices(corpus: Corpus, template: Template, lookups: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified notices of a template: text, first word of its first phrase there, score."""
    text, window = _candidates(corpus, template, lookups)
    first, end = corpus.first_of[text], corpus.first_of[text + 1]
    begin = first + template.begin(window)
    low = np.maximum(begin, first)
    high = np.minimum(begin + len(template.words) + template.width - 1, end)
    starts = np.zeros(len(text), np.int64)
    keep = np.ones(len(text), bool)
    for i, phrase in enumerate(template.phrases):
        inside, at = _within(corpus.phrase(phrase), low, high - len(phrase) + 1)
        keep &= inside
        starts = at if i == 0 else starts
    text, first, end, begin, starts = (x[keep] for x in (text, first, end, begin, starts))
    matched = np.zeros(len(text), np.int64)
    for place, word in enumerate(template.words):
        low = np.maximum(begin + place, first)
        matched += _within(corpus.places(word), low, np.minimum(begin + place + template.width, end))[0]
    keep = matched >= template.needed
    return text[keep], (starts - first)[keep], matched[keep] / len(template.words)


def scan(docs: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """Per row: doc_id, n_words, the base rule's places and labels, all labels, the score, notices.

    The score is the best share of a template's words found where it was aligned; 0 without one.
    ``notices`` lists the templates found: label, word at which the first mandatory phrase stands, and
    the score there. A corpus without licence words gives every row its base result.
    """
    source = docs.select("doc_id", "text")
    schema = (
        f"doc_id {dict(source.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, notices array<struct<label: string, word: long, score: double>>"
    )
    notice = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index()
        rarity = np.array([-np.log(max(frequency.get(w, 0), 1)) for w in index.words])
        looked_up = [(t, t.lookups(rarity)) for t in index.templates]
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in slices(offsets):
                text, numbers = word_numbers(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], index)
                n = j - i
                corpus = Corpus(numbers, text, n, index)
                first_of = corpus.first_of
                places = np.zeros(n, np.int64)
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in index.base:
                    at = corpus.phrase(tuple(phrase))
                    own, inside = text[at], at - first_of[text[at]]
                    np.add.at(places, own, 1)
                    np.minimum.at(low, own, inside)
                    np.maximum.at(high, own, inside)
                    for k in np.unique(own):
                        base[k].add(label)
                labels, scores = [set(b) for b in base], np.zeros(n)
                found: list[dict[tuple[int, str], float]] = [{} for _ in range(n)]
                for template, lookups in looked_up:
                    for k, at, score in zip(*[x.tolist() for x in notices(corpus, template, lookups)], strict=True):
                        labels[k].add(template.label)
                        scores[k] = max(scores[k], score)
                        found[k][at, template.label] = max(score, found[k].get((at, template.label), 0.0))
                some = places > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, n),
                        pa.array(np.diff(first_of)),
                        pa.array(places),
                        pa.array(low, mask=~some),
                        pa.array(high, mask=~some),
                        pa.array([",".join(sorted(b)) for b in base], pa.string()),
                        pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                        pa.array(scores),
                        pa.array([[{"label": x, "word": at, "score": f[at, x]} for at, x in sorted(f)] for f in found], notice),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"],
                )

    return source.mapInArrow(run, schema)


def licence_report(docs: DataFrame) -> DataFrame:
    return scan(docs, document_frequency(docs))
