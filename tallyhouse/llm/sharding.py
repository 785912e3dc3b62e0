"""Shards by vector bin packing: bytes, tokens and rows balanced at once, copies of a text together.

A group of equal texts is a vector of its bytes, tokens and rows; a shard has the same share of each
to give. A group goes where the dot product of its vector with what the shard has left, both as
parts of the totals, is highest, large groups first. Bytes count ``WEIGHTS`` times, as they are the
law that holds.

Groups are counted before the shuffle. One that needs more than ``PIECE`` of a shard in any measure is
cut into pieces, its copies dealt out in turn; there are few of these, whatever the table. Groups of more than
``LARGE`` of a shard are placed by one task, and of those there are at most three times as many as
shards fit large ones. The rest is placed by many tasks, each of which fills the shards in proportion to what
the large ones have left. Within a shard, rows are numbered from counts per range of row numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, numbered

SHARDS = 40
#: Parts of a shard: what a piece of a group may take, and from which a group is placed in one task.
PIECE, LARGE = 0.25, 0.004
#: Of bytes, tokens and rows in the dot product.
WEIGHTS = (8.0, 1.0, 1.0)
#: Bytes that a row takes besides its text.
OVERHEAD = 16
_PER_TASK = 200_000  # groups that one task places
_RANGE = 16  # bits of a row number within a range whose rows are numbered together
_KEY = ["h1", "h2", "piece"]
_MEASURES = ["bytes", "tokens", "rows"]
_PLACED = "h1 long, h2 long, piece int, shard int"


def count_words(text: Column) -> Column:
    """Words between white space, as a stand-in for tokens."""
    return F.regexp_count(text, F.lit(r"[^ \t-\r]+"))


def _facts(docs: DataFrame, tokens: Column) -> tuple[DataFrame, str]:
    source, row = numbered(docs, "documents")
    text = F.coalesce("text", F.lit(""))
    facts = source.select(
        F.col(row).alias("row"),
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(tokens.cast("long"), F.lit(0).cast("long")).alias("tokens"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    )
    return cut_lineage(facts, "facts"), row


def _groups(rows: DataFrame, *by: str) -> DataFrame:
    """Vectors of groups. Two texts meet in a group with a chance of 2**-128."""
    return rows.groupBy(*by).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))


class Shards:
    """What shards have left in each measure, as parts of the totals."""

    def __init__(self, left: np.ndarray):
        self.left = left.copy()

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The shards for vectors, one after the other; ties go to the first shard."""
        out = np.empty(len(vectors), np.int32)
        left, wanted = self.left, vectors * WEIGHTS
        for i, v in enumerate(vectors):
            s = int(np.argmax(left @ wanted[i]))
            left[s] -= v
            out[i] = s
        return out


def _sorted(vectors: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Large vectors first; equal ones by key, so that a repeated task decides alike."""
    return np.lexsort((*keys.T[::-1], -vectors.max(axis=1)))


def _place(units: DataFrame, totals: np.ndarray, left: np.ndarray) -> DataFrame:
    """Places each task's units, which it holds as numbers, in shards with its part of what is left."""
    scale = 1.0 / np.maximum(totals, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
        if not table:
            return
        table = np.concatenate(table)
        keys, vectors = table[:, :3], table[:, 3:] * scale
        order = _sorted(vectors, keys)
        keys, vectors = keys[order], vectors[order]
        open_space = np.maximum(left, 0.0)
        own = open_space * (vectors.sum(axis=0) / np.maximum(open_space.sum(axis=0), 1e-300))
        shard = Shards(own).place(vectors)
        for i in range(0, len(shard), 1 << 16):
            part = keys[i : i + (1 << 16)]
            columns = [pa.array(part[:, 0]), pa.array(part[:, 1]), pa.array(part[:, 2].astype(np.int32)), pa.array(shard[i : i + (1 << 16)])]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "piece", "shard"])

    return units.select("h1", "h2", F.col("piece").cast("long"), *_MEASURES).mapInArrow(run, _PLACED)


def placed_groups(groups: DataFrame, totals: np.ndarray, shards: int = SHARDS) -> DataFrame:
    """Shard of each group or piece (h1, h2, piece, bytes, tokens, rows; a stored table)."""
    share = totals / shards
    is_large = F.lit(False)
    for name, part in zip(_MEASURES, share, strict=True):
        is_large = is_large | (F.col(name) > LARGE * float(part))
    even = np.full((shards, len(totals)), 1.0 / shards)
    big = cut_lineage(_place(groups.where(is_large).coalesce(1), totals, even), "large")
    taken = groups.join(F.broadcast(big), _KEY).groupBy("shard").agg(*[F.sum(m).alias(m) for m in _MEASURES]).collect()
    left = even.copy()
    for r in taken:
        left[r["shard"]] -= np.array([r[m] for m in _MEASURES], float) / np.maximum(totals, 1.0)
    small = groups.where(~is_large)
    tasks = max(1, -(-groups.count() // _PER_TASK))
    return big.unionByName(_place(small.repartition(tasks, *_KEY), totals, left))


def with_slots(rows: DataFrame, by: str) -> DataFrame:
    """Numbers the rows (a stored table with ``row``) of each value of ``by`` from 0, without gaps, as
    ``slot``: the running sum of counts over ranges of row numbers, then the place in the range."""
    rows = rows.withColumn("range", F.shiftright("row", _RANGE))
    counts = cut_lineage(rows.groupBy("range", by).agg(F.count(F.lit(1)).alias("n")), "ranges")
    before = F.sum("n").over(Window.partitionBy(by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut_lineage(counts.select("range", by, F.coalesce(before, F.lit(0)).alias("first")), "starts")
    place = F.row_number().over(Window.partitionBy("range", by).orderBy("row")) - 1
    return rows.withColumn("place", place).join(starts, ["range", by]).withColumn("slot", F.col("first") + F.col("place")).drop("range", "place", "first")


def shard_documents(docs: DataFrame, shards: int = SHARDS, tokens: Column | None = None) -> DataFrame:
    """Shard and slot of each row of ``docs`` (doc_id, text; law "bytes": shards of near equal size).

    Columns: doc_id, size (UTF-8 bytes and ``OVERHEAD``), text_crc32, law, shard, slot (gapless from
    0 in each shard), grown_shard (null) and n_tokens. ``tokens`` counts a row's tokens from its columns; by
    default words stand for them. Null text counts as empty, long texts are read whole, copies share a shard unless
    their group is cut, repeated rows are copies, ties go to the first shard, an empty table gives
    none; other columns of any name are left out.
    """
    facts, _ = _facts(docs, count_words(F.col("text")) if tokens is None else tokens)
    groups = cut_lineage(_groups(facts, "h1", "h2").withColumn("piece", F.lit(0)), "groups")
    row = groups.agg(*[F.sum(m).alias(m) for m in _MEASURES]).first()
    totals = np.array([row[m] or 0 for m in _MEASURES], float)
    need = F.greatest(*[F.ceil(F.col(m) / max(PIECE * float(t) / shards, 1e-9)) for m, t in zip(_MEASURES, totals, strict=True)])
    pieces = F.least(need, F.col("rows")).cast("int")
    # Sums over groups equal the totals, so fewer than 3 * shards / PIECE groups can need a cut.
    hot = F.broadcast(cut_lineage(groups.where(pieces > 1).select("h1", "h2", pieces.alias("pieces")), "hot"))
    own = ["row", "doc_id", "size", "text_crc32", "tokens", "h1", "h2"]
    dealt = with_slots(cut_lineage(facts.join(hot, ["h1", "h2"]).select(*own, "pieces"), "copies"), "h1")
    dealt = cut_lineage(dealt.select(*own, F.pmod("slot", "pieces").cast("int").alias("piece")), "dealt")
    facts = facts.join(hot, ["h1", "h2"], "left_anti").select(*own, F.lit(0).alias("piece")).unionByName(dealt)
    parts = _groups(dealt, *_KEY)
    units = cut_lineage(groups.where(pieces <= 1).select(*_KEY, *_MEASURES).unionByName(parts.select(*_KEY, *_MEASURES)), "units")
    placed = cut_lineage(placed_groups(units, totals, shards), "placed")
    rows = cut_lineage(facts.join(placed, _KEY).select("row", "doc_id", "size", "text_crc32", "tokens", "shard"), "sharded")
    return with_slots(rows, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("tokens").alias("n_tokens")
    )


def shard_sizes(sharded: DataFrame) -> DataFrame:
    """Per shard: bytes, tokens, rows."""
    return sharded.groupBy("shard").agg(F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
