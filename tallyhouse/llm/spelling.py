"""Spelling variants: words one edit apart, found with a bit-sliced position index.

The index holds, for each position and letter, the bit set of the words that have this letter
there. A word is looked up letter by letter. Four bit sets go along, each for all indexed words at
once: the words that agree so far (no error), and those that agree but for one replaced, one
inserted or one deleted letter. The last two read the index one position to the right or left.

Two words one edit apart share their first or their last letters, half of the shorter one's or
more. The vocabulary is therefore indexed in blocks of words with equal beginnings or equal ends, and a
pair that shares both counts in the first kind only. A block of many words is cut into slices, and
each pair of slices is a piece of work of its own, so no task ever holds more than two slices.
Found pairs are never written one by one: a lookup gives a count and the most frequent neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: Words of a block that are indexed together.
SLICE = 4096
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOUND = "word string, near long, top long, best string"


def runs(docs: DataFrame) -> DataFrame:
    """Each run of Latin letters of each text, as doc_id and run, A to Z in lower case.

    Null and empty texts have none; repeated rows count again; texts are read whole.
    """
    pieces = docs.select("doc_id", F.explode(F.split("text", r"[^A-Za-zÀ-ÿ]+")).alias("run")).where("run != ''")
    # lower() would also change letters with marks
    plain = F.when(F.col("run").rlike("[À-Þ]"), F.translate("run", _CAPITALS, _CAPITALS.lower()))
    return pieces.select("doc_id", plain.otherwise(F.lower("run")).alias("run"))


def with_slips(found: DataFrame, one_in: int) -> DataFrame:
    """Runs as a hasty writer leaves them: one letter missing in one of ``one_in`` on average, chosen
    by a checksum of document and run. A null doc_id is written as nothing."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    marked = found.select("doc_id", "run", F.crc32(name.cast("binary")).alias("_h"))
    at = F.pmod(F.col("_h"), F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return marked.select("doc_id", F.when(F.col("_h") % one_in == 0, shorter).otherwise(F.col("run")).alias("run"))


def vocabulary(found: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of enough letters that occur often enough: word, n. Counted before the shuffle."""
    words = found.select(F.col("run").alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _blocks(words: DataFrame, shortest: int) -> DataFrame:
    """Each word in the blocks where its neighbours are: (span, tail, affix, word, n).

    Block ``span`` compares words of that length with each other and with those one longer; the
    affix has half as many letters.
    """

    def block(span: Column, tail: bool) -> Column:
        half = F.floor(span / 2).cast("int")
        affix = F.when(half > 0, F.right("word", half) if tail else F.left("word", half)).otherwise("")
        return F.struct(span.alias("span"), F.lit(tail).alias("tail"), affix.alias("affix"))

    size = F.length("word")
    every = F.array(*[block(span, tail) for span in (size, size - 1) for tail in (False, True)])
    return words.select(F.explode(every).alias("b"), "word", "n").where(F.col("b.span") >= shortest).select("b.*", "word", "n")


def _tiles(blocks: DataFrame, slice_words: int) -> DataFrame:
    """Rows of blocks with company, once for each pair of slices they take part in: as a word to look
    up (asks), as an indexed word (indexed) or both."""
    key = ["span", "tail", "affix"]
    sizes = blocks.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    cut = blocks.join(sizes, key).withColumn("slices", F.ceil(F.col("size") / slice_words).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    own, others = F.col("own"), F.sequence(F.lit(0), F.col("slices") - 1)

    def tile(a: Column, b: Column) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), (a == own).alias("asks"), (b == own).alias("indexed"))

    as_asking = F.transform(others, lambda b: tile(own, b))
    as_indexed = F.transform(F.filter(others, lambda a: a != own), lambda a: tile(a, own))
    return cut.select(*key, "word", "n", F.explode(F.concat(as_asking, as_indexed)).alias("t")).select(*key, "t.a", "t.b", "word", "n", "t.asks", "t.indexed")


class PositionIndex:
    """Bit sets of words by position and letter. Bits follow frequency, then code points, so the lowest
    bit of a result is the neighbour wanted first."""

    def __init__(self, words: list[tuple[str, int]]):
        self.words = sorted(words, key=lambda w: (-w[1], w[0]))
        self.all = (1 << len(words)) - 1
        self.at: list[dict[str, int]] = [{} for _ in range(1 + max((len(w) for w, _ in words), default=0))]
        self.of_length: dict[int, int] = {}
        for i, (word, _) in enumerate(self.words):
            bit = 1 << i
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit
            for place, letter in zip(self.at, word):  # noqa: B905  a place more than letters
                place[letter] = place.get(letter, 0) | bit

    def _with(self, place: int, letter: str) -> int:
        return self.at[place].get(letter, 0) if 0 <= place < len(self.at) else 0

    def near(self, word: str, first: int, last: int, apart: int = 0) -> int:
        """Words one edit from ``word`` within its letters first to last, as a bit set. All indexed
        words must share what lies before and after. Of the words that share the first ``apart``
        letters too, none is given."""
        same, replaced, longer, shorter, taken = self.all, 0, 0, 0, 0
        for i in range(first, last):
            letter = word[i]
            here = self._with(i, letter)
            replaced = (replaced & here) | (same & ~here)
            longer = (longer | same) & self._with(i + 1, letter)
            shorter = (shorter & self._with(i - 1, letter)) | same
            same &= here
            if i + 1 == apart:
                taken = same
        size, of = len(word), self.of_length.get
        found = (replaced & of(size, 0)) | ((longer | same) & of(size + 1, 0)) | (shorter & of(size - 1, 0))
        return found & ~taken


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Looks up the words of each tile; tiles arrive whole, one after the other."""

    def flush(rows):
        word, near, top, best = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(top, pa.int64()), pa.array(best, pa.string())],
            names=["word", "near", "top", "best"],
        )

    rows = chain.from_iterable(zip(*[c.to_pylist() for c in b.columns], strict=True) for b in batches)
    out = []
    for (span, tail, _, _, _), tile in groupby(rows, key=lambda r: r[:5]):
        tile = list(tile)
        index = PositionIndex([(r[5], r[6]) for r in tile if r[8]])
        shorter_only = index.of_length.get(span, 0)
        half = span // 2
        for r in tile:
            if not r[7]:
                continue
            word = r[5]
            found = index.near(word, 0, len(word) - half, half) if tail else index.near(word, half, len(word))
            if len(word) > span:  # words of this length meet each other in a block of their own
                found &= shorter_only
            if found:
                best, n = index.words[(found & -found).bit_length() - 1]
                out.append((word, found.bit_count(), n, best))
        if len(out) > 10_000:
            yield flush(out)
            out = []
    if out:
        yield flush(out)


def neighbours(words: DataFrame, slice_words: int = SLICE) -> DataFrame:
    """For each word (word, n; no word twice) that has any word one edit apart: word, n_near (how many),
    best and top (the most frequent one, ties to the smallest, and its n). An empty table gives none."""
    words = words.select("word", "n")
    shortest = words.agg(F.min(F.length("word"))).first()[0] or 0
    key = ["span", "tail", "affix", "a", "b"]
    tiles = _tiles(cut_lineage(_blocks(words, shortest), "blocks"), slice_words)
    found = tiles.repartition(*key).sortWithinPartitions(*key).mapInArrow(_search, _FOUND)
    first = F.min(F.struct((-F.col("top")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("f")).select("word", "n_near", "f.best", (-F.col("f.less")).alias("top"))


def _roots(forms: DataFrame) -> DataFrame:
    """Where each word's forms lead to in the end: word, root. Each turn doubles the way; forms are
    ever more frequent, so there are no rings and few turns."""
    ways = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        longer = cut_lineage(ways.join(on, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        ways = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return ways


def variants(words: DataFrame, ratio: int = RATIO, slice_words: int = SLICE) -> DataFrame:
    """Words (word, n) with their form and root: word, form, root, n, n_near, form_n.

    The form is the most frequent word one edit apart (ties: the smallest in code-point order) if it
    is at least ``ratio`` times as frequent, else null; the root is where forms lead, the word
    itself if it has none.
    """
    words = cut_lineage(words.select("word", "n"), "words")
    near = words.join(neighbours(words, slice_words), "word", "left")
    frequent = F.col("top") >= ratio * F.col("n")
    judged = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("best")).alias("form"), F.when(frequent, F.col("top")).alias("form_n")
    )
    judged = cut_lineage(judged, "forms")
    rooted = judged.join(_roots(judged.where("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(
    docs: DataFrame, slips: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, slice_words: int = SLICE
) -> DataFrame:
    """Spelling variants over the whole texts of ``docs`` (doc_id, text), as ``variants`` gives them.

    Null and empty texts have no words, long texts are read whole, repeated rows count again, equal
    counts are decided by code points, other columns of any name are left out, an empty table gives
    no words. With ``slips`` the runs are damaged first (``with_slips``), which plants variants
    whose form is known.
    """
    found = runs(docs)
    return variants(vocabulary(with_slips(found, slips) if slips else found, min_length, min_count), ratio, slice_words)
