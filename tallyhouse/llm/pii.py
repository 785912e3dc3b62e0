"""Personal data by bootstrapped contextual extraction.

Seed entities are what four fixed rules find: e-mail and IP addresses, card numbers, phone numbers.
The words around a seed, or around any other token with a digit or an at sign, are lexical patterns:
the two words before it, the words on both sides, and the two words after it. Patterns and the
instances they surround form a graph, which Spark scores in turns: a pattern by the share of its
different instances that are believed to be of a kind, an instance by the patterns that surround
it. Patterns of high confidence then mark tokens that no rule knows. Copies of a document add
nothing, as each pair of pattern and instance counts once.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, numbered

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 3  # different believed instances that a pattern needs
MIN_CONFIDENCE = 0.8
ROUNDS = 3
_MIN_LENGTH = 6

# The rules, written so that no text takes more than linear time: an address is looked for
# from its at sign, and a run of digits is entered at its first digit only.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>#*$%&|"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of what the fixed rules find, in order. A match that fails its check is
    dropped and not tried again in a shorter form."""
    spans = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _hash(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def units(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list[int]]]:
    """Seeds and other tokens that may identify someone: start, end, instance, kind (-1: none known)
    and the patterns around it. A text without digit and at sign has none."""
    if not spans and not _DIGIT.search(text) and "@" not in text:
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    found = [(a, b, k) for a, k, b in spans]
    covered_to, seeds = 0, sorted((a, b) for a, _, b in spans)
    at = 0
    for a, b in words:
        while at < len(seeds) and seeds[at][0] < b:
            covered_to = max(covered_to, seeds[at][1])
            at += 1
        if covered_to > a:
            continue
        token = text[a:b]
        if not (_DIGIT.search(token) or "@" in token):
            continue
        core = token.strip(_EDGE)
        if len(core) >= _MIN_LENGTH:
            first = a + token.index(core)
            found.append((first, first + len(core), -1))
    out = []
    for a, b, kind in found:
        i, j = bisect_right(ends, a) - 1, bisect_left(starts, b)
        left = [text[x:y].lower() for x, y in words[max(0, i - 1) : i + 1]]
        right = [text[x:y].lower() for x, y in words[j : j + 2]]
        patterns = []
        if len(left) == 2:
            patterns.append(_hash("before", *left))
        if left and right:
            patterns.append(_hash("around", left[-1], right[0]))
        if len(right) == 2:
            patterns.append(_hash("after", *right))
        out.append((a, b, _hash(text[a:b].lower()), kind, patterns))
    return out


_SCAN = (
    "row long, doc_id {kind}, base array<struct<start:long,kind:int,end:long>>, "
    "units array<struct<start:long,end:long,instance:long,kind:int,patterns:array<long>>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    unit_kind = pa.list_(
        pa.struct(
            [("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("kind", pa.int32()), ("patterns", pa.list_(pa.int64()))]
        )
    )
    for batch in batches:
        base, marked = [], []
        for text in batch.column(2):
            text = text.as_py() or ""
            spans = rule_spans(text)
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            marked.append(
                [{"start": a, "end": b, "instance": i, "kind": k, "patterns": p} for a, b, i, k, p in units(text, spans)]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base, base_kind), pa.array(marked, unit_kind)], names=["row", "doc_id", "base", "units"]
        )


def score_patterns(
    edges: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """The patterns to trust (pattern, kind, confidence), from edges (pattern, instance, seed).

    ``seed`` is the kind of a seed instance, else -1. A turn scores patterns by their instances
    (with one doubtful instance added, so that few instances cannot give certainty) and instances
    by their patterns; seeds stay certain.
    """
    edges = cut_lineage(edges.distinct(), "edges")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("size"))
    seeds = edges.where("seed >= 0").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("belief")).distinct()
    pairs = edges.select("pattern", "instance").distinct()
    beliefs, trusted = seeds, None
    for _ in range(rounds):
        sums = pairs.join(beliefs, "instance").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("belief"), F.count(F.when(F.col("belief") >= 0.5, 1)).alias("support")
        )
        scored = sums.join(sizes, "pattern").withColumn("confidence", F.col("belief") / (F.col("size") + 1.0))
        trusted = cut_lineage(
            scored.where((F.col("support") >= min_support) & (F.col("belief") >= min_confidence * F.col("size"))).select(
                "pattern", "kind", "confidence"
            ),
            "patterns",
        )
        if trusted.isEmpty():
            break
        doubt = F.sum(F.log(1.0 - F.least(F.col("confidence"), F.lit(0.99))))
        new = pairs.join(trusted, "pattern").groupBy("instance", "kind").agg((1.0 - F.exp(doubt)).alias("belief"))
        new = new.join(seeds.select("instance").distinct(), "instance", "left_anti")
        beliefs = cut_lineage(seeds.unionByName(new), "beliefs")
    return trusted


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """Per row: row, doc_id, ``base`` (what the rules find) and ``spans`` (with what patterns add),
    arrays of start, kind (index in KINDS) and end in code points, sorted.

    Added spans overlap no span of the rules; of added ones that would overlap, the first stays.
    Null text counts as empty. Texts are read whole. Repeated rows are rows of their own.
    """
    source, row = numbered(docs.select("doc_id", "text"), "documents")
    found = source.select(F.col(row).alias("row"), "doc_id", "text").mapInArrow(_scan, _SCAN.format(kind=dict(docs.dtypes)["doc_id"]))
    found = cut_lineage(found, "seeds")
    places = found.where(F.size("units") > 0).select("row", F.explode("units").alias("u"))
    edges = places.select("u.instance", F.col("u.kind").alias("seed"), F.explode("u.patterns").alias("pattern"))
    trusted = score_patterns(edges.select("pattern", "instance", "seed"), **options)
    unknown = places.where("u.kind < 0").select("row", "u.start", "u.end", F.explode("u.patterns").alias("pattern"))
    added = (
        unknown.join(trusted, "pattern")
        .groupBy("row", "start", "end")
        .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k")))["k"].alias("k"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", (-F.col("k")).alias("kind"), "end")).alias("added"))
    )
    joined = found.select("row", "doc_id", "base").join(added, "row", "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.select("row", "doc_id", "base", spans.alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start and then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, counts by kind, a digest of the rules' spans, and all spans."""
    found = personal_data(docs, **options)

    def of_kind(i: int):
        return lambda span: span["kind"] == i  # of one parameter: Spark passes the index as a second one

    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans")
    )
