"""Near-duplicate documents by BagMinHash: weighted Jaccard over multisets of word shingles.

A document is the multiset of its five-word shingles (fewer than five words: one shingle of all).
Each shingle's weight, its count, is an interval from zero, discretised at the integers and cut into
the dyadic pieces [0,1), [1,2), [2,4), [4,8) ... Every piece of every shingle carries a Poisson
process whose points are drawn in rising order from a hash alone, so two documents see the same
points. A point has a component of the signature and a place in its piece, found by halving, and
counts where the place lies below the weight. The lowest point of each component is the signature:
two signatures agree in a component with a chance equal to the weighted Jaccard similarity.

Bands of components give bucket keys, and ``linking`` compares within buckets by exact similarity.
With the default bands a pair at similarity 0.8 shares a bucket with a chance of 1 - 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, few_rows, numbered, slices, small_batches, text_buffer
from tallyhouse.llm.linking import link
from tallyhouse.llm.vector import NOT_SPACE, mix, span_hashes, spans, windows

BANDS, ROWS = 42, 6
SHINGLE = 5
#: Similarity as a fraction, so that the comparison is exact.
SIMILAR = (4, 5)
_BLOCK_WORDS = 100_000
_POINTS = 1 << 16  # drawn at once while few processes are left
_U = np.uint64


def shingle_counts(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each different shingle of each text, sorted by text and hash."""
    a, b, text = spans(data, offsets, NOT_SPACE)
    window, full = windows(span_hashes(data, a, b), text, width, short=True)
    window, text = window[full], text[full]
    order = np.lexsort((window, text))
    window, text = window[order], text[order]
    new = np.ones(len(window), bool)
    new[1:] = (window[1:] != window[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], window[at], np.diff(np.append(at, len(window)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, size: int) -> np.ndarray:
    """``n`` signatures of ``size`` components; a text without shingles has infinite ones."""
    weight = np.bincount(text, count, n)
    best = np.full(n * size, np.inf)
    todo = weight > 0
    reach = np.log(size) + 2.0
    top = int(count.max(initial=0)).bit_length()
    while todo.any():
        with np.errstate(divide="ignore"):
            horizon = np.where(todo, reach / weight, 0.0)
        for level in range(top + 1):
            low = 0 if level == 0 else 1 << (level - 1)
            width = 1 if level == 0 else low
            has = np.flatnonzero(todo[text] & (count > low))
            if not len(has):
                break
            key = mix(shingle[has] ^ mix(np.array([level], _U)))
            below, until, time, place = count[has], horizon[text[has]], np.zeros(len(has)), text[has] * size
            k = 0
            while len(key):
                # Few processes: many points of each at once. The sums run in the same order either way.
                ahead = max(1, min(4096, _POINTS // len(key)))
                steps = np.arange(k + 1, k + ahead + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)
                drawn = mix(key[:, None] + steps[None, :])
                gaps = -np.log(((drawn >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / (size * width)
                gaps[:, 0] += time
                times = np.cumsum(gaps, axis=1) if ahead > 1 else gaps
                process, step = np.nonzero(times < until[:, None])
                at, drawn = times[process, step], mix(drawn[process, step])
                component = place[process] + (((drawn & _U(0xFFFFFFFF)) * _U(size)) >> _U(32)).astype(np.int64)
                if level > 1:
                    counts = low + ((drawn >> _U(32)) & _U(width - 1)).astype(np.int64) < below[process]
                    at, component = at[counts], component[counts]
                np.minimum.at(best, component, at)
                k += ahead
                on = np.flatnonzero(times[:, -1] < until)
                key, below, until, time, place = key[on], below[on], until[on], times[on, -1], place[on]
        todo = todo & np.isinf(best.reshape(n, size)).any(axis=1)
        reach *= 1.5
    return best.reshape(n, size)


def band_keys(best: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A bucket key for each band of each signature, different in every band."""
    words = best.view(_U)[:, : bands * rows].reshape(len(best), bands, rows)
    keys = np.tile(np.arange(bands, dtype=_U), (len(best), 1))
    for i in range(rows):
        keys = mix(keys ^ words[:, :, i])
    return keys.view(np.int64)


def _digests(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Of the words of each text, so that white space does not count."""
    from hashlib import md5

    raw = data.tobytes()
    return [md5(b" ".join(raw[i:j].split()), usedforsecurity=False).digest() for i, j in zip(offsets[:-1], offsets[1:], strict=True)]


def signed(docs: DataFrame, row: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Row, doc_id, digest of the words, and bucket keys (null without a word) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for i, j in slices(offsets):
                part, places = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                text, shingle, count = shingle_counts(part, places)
                best = signatures(text, shingle, count, j - i, bands * rows)
                empty = np.isinf(best[:, 0])
                keys = band_keys(best, bands, rows)
                keys = pa.array([None if e else k for e, k in zip(empty, keys, strict=True)], pa.list_(pa.int64()))
                digest = pa.array(_digests(part, places), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), digest, keys],
                    names=["row", "doc_id", "digest", "keys"],
                )

    source = docs.select(F.col(row).alias("row"), "doc_id", "text")
    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"row long, doc_id {kind}, digest binary, keys array<long>")


def similar(shingles_a: tuple, shingles_b: tuple) -> bool:
    """Whether two multisets (sorted hashes, counts) reach the similarity, in whole numbers."""
    (a, n), (b, m) = shingles_a, shingles_b
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common * SIMILAR[1] >= (int(n.sum()) + int(m.sum()) - common) * SIMILAR[0]


def _each(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    text, shingle, count = shingle_counts(data, offsets)
    cut = np.searchsorted(text, np.arange(len(offsets)))
    return [(shingle[i:j], count[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = text_buffer(batch.column(2)), text_buffer(batch.column(3))
        for i, j in slices(left[1] + right[1]):
            both = []
            for data, offsets in (left, right):
                both.append(_each(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            keep = [similar(x, y) for x, y in zip(*both, strict=True)]
            pairs = pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)], names=["a", "b"])
            yield pairs.filter(pa.array(keep, pa.bool_()))


def _between_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the members of two blocks that lie in different groups, as a forest: a pair
    that earlier links of the block have joined is not compared any more."""
    for batch in batches:
        lines_a, lines_b = batch.column(0), batch.column(1)
        out_a, out_b = [], []
        for side_a, side_b in zip(lines_a, lines_b, strict=True):
            a, b = side_a.values, side_b.values
            ids = [x.field("id").to_pylist() for x in (a, b)]
            group = [x.field("comp").to_pylist() for x in (a, b)]
            bags = [_each(*text_buffer(x.field("text"))) for x in (a, b)]
            weights = [np.array([int(n.sum()) for _, n in bag]) for bag in bags]
            root: dict[int, int] = {}

            def find(x: int, root: dict[int, int] = root) -> int:
                while root.get(x, x) != x:
                    x = root[x]
                return x

            shingle = np.concatenate([s for s, _ in bags[1]])
            count = np.concatenate([n for _, n in bags[1]])
            owner = np.repeat(np.arange(len(bags[1])), [len(s) for s, _ in bags[1]])
            order = np.argsort(shingle, kind="stable")
            shingle, count, owner = shingle[order], count[order], owner[order]
            for i, (s, n) in enumerate(bags[0]):
                first, last = np.searchsorted(shingle, s, "left"), np.searchsorted(shingle, s, "right")
                sizes = last - first
                at = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                common = np.bincount(owner[at], np.minimum(count[at], np.repeat(n, sizes)), len(bags[1])).astype(np.int64)
                whole = weights[0][i] + weights[1] - common
                for j in np.flatnonzero(common * SIMILAR[1] >= whole * SIMILAR[0]):
                    x, y = find(group[0][i]), find(group[1][j])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        out_a.append(ids[0][i])
                        out_b.append(ids[1][j])
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _chooser(texts: DataFrame):
    """Whole texts (row, text) of some rows, as a stored table. Only chosen texts are shuffled later."""

    def chosen(rows: DataFrame) -> DataFrame:
        wanted = cut_lineage(rows.distinct(), "wanted")
        return cut_lineage(texts.join(few_rows(wanted), "row", "left_semi").select("row", "text"), "texts")

    return chosen


def _verifier(chosen):
    """Confirms pairs (a, b) of representatives by their whole texts."""

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = cut_lineage(pairs, "pairs")
        if pairs.isEmpty():
            return pairs
        needed = chosen(pairs.select(F.explode(F.array("a", "b")).alias("row")))
        of_a = needed.select(F.col("row").alias("a"), F.col("text").alias("text_a")).hint("merge")
        of_b = needed.select(F.col("row").alias("b"), F.col("text").alias("text_b")).hint("merge")
        both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "text_a", "text_b")
        with small_batches(pairs.sparkSession, 200):
            return cut_lineage(both.mapInArrow(_confirmed, "a long, b long"), "confirmed")

    return verify


def _all_links(chosen, block_words: int):
    """All links between the groups of open buckets. The members outside a bucket's largest group
    are compared with all members, block by block, so that no task gets a whole bucket."""

    def rest(still: DataFrame) -> DataFrame:
        spark = still.sparkSession
        needed = chosen(still.select(F.col("id").alias("row")))
        needed = needed.select(F.col("row").alias("id"), "text", (F.length("text") / 6 + 1).cast("long").alias("words"))
        sized = still.join(needed.select("id", "words"), "id")
        groups = sized.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words"))
        per_key = groups.groupBy("key").agg(
            F.max(F.struct("n", "comp"))["comp"].alias("main"), F.sum("words").alias("all"), F.max(F.struct("n", "words"))["words"].alias("largest")
        )
        blocks = per_key.select(
            "key",
            "main",
            F.ceil(F.col("all") / block_words).cast("int").alias("of_all"),
            F.ceil((F.col("all") - F.col("largest") + 1) / block_words).cast("int").alias("of_few"),
        )
        placed = still.join(blocks, "key").join(needed, "id")
        few = F.pmod(F.xxhash64("id"), F.col("of_few")).cast("int")
        every = F.pmod(F.xxhash64("id"), F.col("of_all")).cast("int")
        member = F.struct("id", "comp", "text")
        left = placed.where("comp != main").select("key", few.alias("i"), F.explode(F.sequence(F.lit(0), F.col("of_all") - 1)).alias("j"), member.alias("m"))
        right = placed.select("key", F.explode(F.sequence(F.lit(0), F.col("of_few") - 1)).alias("i"), every.alias("j"), member.alias("m"))
        left = left.groupBy("key", "i", "j").agg(F.collect_list("m").alias("some"))
        right = right.groupBy("key", "i", "j").agg(F.collect_list("m").alias("others"))
        met = left.join(right, ["key", "i", "j"]).select("some", "others")
        with small_batches(spark, 8):
            return cut_lineage(met.mapInArrow(_between_blocks, "a long, b long").distinct(), "rest")

    return rest


def near_duplicates(docs: DataFrame, block_words: int = _BLOCK_WORDS) -> tuple[DataFrame, DataFrame, str]:
    """The rows as stored with a number, that number's name, and per row its class.

    Classes (row, doc_id, class_id, class_size, is_first): connected groups of documents whose
    weighted Jaccard similarity is 0.8 or more. ``class_id`` is the smallest doc_id of the class
    and ``is_first`` marks one row of it. Null text counts as empty; texts without a word are
    copies of each other. Rows with a null doc_id take part (class_id null if all are null).
    Equal texts, repeated rows and texts that differ in white space only are merged by digest
    before any bucket is made.
    """
    stored, row = numbered(docs, "documents")
    with small_batches(docs.sparkSession, 1000):
        signs = cut_lineage(signed(stored, row), "signatures")
    classes = cut_lineage(
        signs.groupBy("digest").agg(
            F.min("row").alias("id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n")
        ),
        "digests",
    )
    firsts = signs.join(classes.select(F.col("id").alias("row")), "row")
    members = firsts.select(F.explode("keys").alias("key"), F.col("row").alias("id"))
    texts = stored.select(F.col(row).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = _chooser(texts)
    labels = link(members, _verifier(chosen), _all_links(chosen, block_words))

    classes = classes.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    per_class = cut_lineage(classes.groupBy("comp").agg(F.min("first").alias("first"), F.sum("n").alias("class_size")), "sizes")
    classes = cut_lineage(classes.select("digest", "comp").join(per_class, "comp"), "classes")
    result = signs.select("row", "doc_id", "digest").join(classes, "digest")
    return (
        stored,
        result.select(
            "row", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("is_first")
        ),
        row,
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, in the columns of ``docs``."""
    stored, classes, row = near_duplicates(docs)
    first = classes.where("is_first").select(F.col("row").alias(row))
    return stored.join(first.hint("shuffle_hash"), row, "left_semi").select(*[f"`{c}`" for c in docs.columns])
