"""Quality rules, line first: lines that fail a rule go, then documents that lost too much text.

Rules of a line (``LineRules`` holds the thresholds; lines without a word always stay):

* symbols: more than a share of its characters are of ``# * $ % & | < >``
* navigation: three or more separators (``|``) and one to every few words, or a short line
  that is a menu entry
* shouting: most letters are capitals and there are exclamation marks
* punctuation: a long line without any punctuation mark
* boilerplate: a short line with a stock phrase of web sites

A document is rejected outright by two base rules (too few words; too many words in repeated
three-word windows), otherwise when the failed lines held more than a share of its characters.

Null text counts as empty: no words, so base_failed. Very long texts are worked through whole.
Repeated rows get equal results; an empty table gives an empty one; other columns are untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tallyhouse.llm.common import free_name, slices, text_buffer
from tallyhouse.llm.vector import NOT_SPACE, byte_class, span_hashes, spans, windows


@dataclass(frozen=True)
class LineRules:
    max_symbols: float = 0.10
    separators_per_word: float = 0.2
    max_capitals: float = 0.6
    exclaimed_per_word: float = 0.25
    unpunctuated_words: int = 10
    boilerplate_words: int = 20
    min_words: int = 50
    max_repeated: float = 0.5
    max_lost: float = 0.3


# Stock phrases of web sites, lower case.
_STOCK = re.compile(
    rb"\b(?:click here|cookie policy|privacy policy|terms of (?:use|service)|sign up for|log in to|subscribe to our|"
    rb"enable javascript|all rights reserved|back to top|skip to content|read more|share this)\b"
)
_MENU = re.compile(rb"\s*(?:home|menu|login|log in|sign in|sign up|register|search|next|previous|back|contact|about|sitemap)\s*")

_NEWLINE = 0x0A
_SYMBOL = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_CAPITAL = byte_class((0x41, 0x5A))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_MARK = byte_class(*[(ord(c), ord(c)) for c in ".,;:!?\"')]"], (0xE2, 0xE2), (0xE3, 0xE3))
_BANG = byte_class((0x21, 0x21))
_BAR = byte_class((0x7C, 0x7C))

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_failed", "chars_lost")


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def _judge(data: np.ndarray, offsets: np.ndarray, rules: LineRules) -> tuple[dict[str, np.ndarray], list[bytes]]:
    """Measures of each text, and the texts without their failed lines."""
    n = len(offsets) - 1
    a, b, text = spans(data, offsets, NOT_SPACE)
    point = (data & 0xC0) != 0x80
    word_chars = _sums(point, a, b)

    # Lines: a text is cut at each newline, so it has one line more than newlines.
    breaks = np.flatnonzero(data == _NEWLINE)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    line_start = np.concatenate([offsets[:-1], breaks + 1])
    line_end = np.concatenate([breaks, offsets[1:]])
    line_text = np.concatenate([np.arange(n), owner])
    by_start = np.lexsort((line_start, line_text))
    line_start, line_text = line_start[by_start], line_text[by_start]
    line_end = line_end[np.lexsort((line_end, np.concatenate([owner, np.arange(n)])))]

    first_word, last_word = np.searchsorted(a, line_start), np.searchsorted(a, line_end)
    words = last_word - first_word
    hashes = span_hashes(data, a, b)
    line_hash = span_hashes(data, line_start, line_end)

    with_word = np.flatnonzero(words > 0)
    order = with_word[np.lexsort((with_word, line_hash[with_word], line_text[with_word]))]
    again = (line_hash[order][1:] == line_hash[order][:-1]) & (line_text[order][1:] == line_text[order][:-1])
    dup_lines = np.bincount(line_text[order][1:][again], minlength=n)

    window, full = windows(hashes, text, 3, short=False)
    at = np.flatnonzero(full)
    order = at[np.lexsort((window[at], text[at]))]
    same = (window[order][1:] == window[order][:-1]) & (text[order][1:] == text[order][:-1])
    covered = np.zeros(len(a), bool)
    for start in (order[1:][same], order[:-1][same]):
        for k in range(3):
            covered[start + k] = True

    chars = _sums(point, line_start, line_end)
    symbols = _sums(_SYMBOL[data], line_start, line_end)
    letters = np.maximum(_sums(_LETTER[data], line_start, line_end), 1)
    capitals = _sums(_CAPITAL[data], line_start, line_end)
    bangs = _sums(_BANG[data], line_start, line_end)
    bars = _sums(_BAR[data], line_start, line_end)
    marks = _sums(_MARK[data], line_start, line_end)
    failed = (
        (symbols > rules.max_symbols * chars)
        | ((bars >= 3) & (bars >= rules.separators_per_word * words))
        | ((capitals > rules.max_capitals * letters) & (bangs >= np.maximum(2, rules.exclaimed_per_word * words)))
        | ((words >= rules.unpunctuated_words) & (marks == 0))
    )
    raw = data.tobytes()
    for i in np.flatnonzero((words > 0) & (words <= rules.boilerplate_words) & ~failed):
        line = raw[line_start[i] : line_end[i]].lower()
        failed[i] = bool(_STOCK.search(line) or _MENU.fullmatch(line))
    failed &= words > 0

    n_words = np.bincount(text, minlength=n)
    measures = {
        "n_words": n_words,
        "word_chars": np.bincount(text, word_chars, n).astype(np.int64),
        "n_symbols": _sums(_SYMBOL[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(text[covered], minlength=n),
        "n_lines_failed": np.bincount(line_text[failed], minlength=n),
        "chars_lost": np.bincount(line_text[failed], chars[failed], n).astype(np.int64),
    }
    measures["base_failed"] = (n_words < rules.min_words) | (measures["n_repeat_words"] > rules.max_repeated * n_words)
    all_chars = _sums(point, offsets[:-1], offsets[1:])
    measures["kept"] = ~measures["base_failed"] & (measures["chars_lost"] <= rules.max_lost * all_chars)

    cleaned: list[bytes] = []
    bounds = np.searchsorted(line_text, np.arange(n + 1))
    hit = measures["n_lines_failed"] > 0
    for i in range(n):
        if hit[i]:
            lines = [k for k in range(bounds[i], bounds[i + 1]) if not failed[k]]
            cleaned.append(b"\n".join(raw[line_start[k] : line_end[k]] for k in lines))
        else:
            cleaned.append(raw[offsets[i] : offsets[i + 1]])
    return measures, cleaned


def judge_lines(docs: DataFrame, rules: LineRules = LineRules(), with_text: bool = True) -> DataFrame:
    """Adds to each row the struct ``quality``: measures, base_failed, kept and the text left
    (null stays null). ``with_text=False`` leaves out the text and all columns but doc_id."""
    kinds = [(m, LongType()) for m in _MEASURES] + [("base_failed", BooleanType()), ("kept", BooleanType())]
    if with_text:
        kinds.append(("cleaned", StringType()))
    name = free_name(docs, "quality")
    quality = StructType([StructField(k, t) for k, t in kinds])
    source = docs if with_text else docs.select("doc_id", "text")
    schema = StructType([*(source.schema if with_text else source.select("doc_id").schema), StructField(name, quality)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            data, offsets = text_buffer(texts)
            for i, j in slices(offsets):
                part = data[offsets[i] : offsets[j]]
                measures, cleaned = _judge(part, offsets[i : j + 1] - offsets[i], rules)
                fields = [pa.array(measures[k]) for k, _ in kinds if k != "cleaned"]
                if with_text:
                    gone = ~np.asarray(texts.slice(i, j - i).is_valid())
                    left = pa.array([None if g else c for g, c in zip(gone, cleaned, strict=True)], pa.binary())
                    fields.append(left.cast(pa.string()))
                struct = pa.StructArray.from_arrays(fields, names=[k for k, _ in kinds])
                columns = batch.slice(i, j - i).columns if with_text else [batch.column(0).slice(i, j - i)]
                yield pa.RecordBatch.from_arrays([*columns, struct], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents with the lines left, in the columns of ``docs``."""
    judged = judge_lines(docs, rules)
    name = judged.columns[-1]
    return judged.where(F.col(name)["kept"]).select(
        *[F.col(name)["cleaned"].alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    )


def quality_report(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: doc_id, measures, base_failed, kept."""
    return judge_lines(docs.select("doc_id", "text"), rules, with_text=False).select("doc_id", "quality.*")
