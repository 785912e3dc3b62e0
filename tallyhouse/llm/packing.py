"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bounded-space online best fit: each task keeps a fixed number of open bins. A bit set holds the free
spaces that open bins have, so the tightest bin that fits is the lowest set bit from the piece's
length on. When a bin more would be open than allowed, the fullest one closes first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyhouse.llm.common import cut_lineage, slices, text_buffer
from tallyhouse.llm.tokens import encoder

CAPACITY = 2048
OPEN_BINS = 1024
_PER_TASK = 1 << 18  # pieces that one task packs, so that few bins stay open at the end of a task
_SLICE = 1 << 20  # bytes of text tokenised together: the arrays over them take many times that
END = 0  # the id after each document


def piece_lengths(total: int, capacity: int) -> list[int]:
    """Only a longer document is cut; its first piece takes what the full ones leave."""
    rest = total % capacity if total > capacity else total
    return ([rest] if rest else []) + [capacity] * ((total - rest) // capacity)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of each row: doc_id, piece, start, length, ids_crc32, with ``ids`` if asked."""
    source = docs.select("doc_id", "text")
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in slices(offsets, _SLICE):
                owner, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, doc in enumerate(encode(data, offsets[i : j + 1])):
                    doc = np.append(doc, np.uint32(END)).astype("<u4")
                    at = 0
                    for n, size in enumerate(piece_lengths(len(doc), capacity)):
                        owner.append(i + k)
                        piece.append(n)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(doc[at : at + size]))
                        if with_ids:
                            ids.append(doc[at : at + size].astype(np.int32))
                        at += size
                columns = [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


class OpenBins:
    """Best fit over at most ``limit`` open bins."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free = 0  # bit f: some open bin has f places left
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        stack = self.bins[space]
        number = stack.pop()
        if not stack:
            self.free ^= 1 << space
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            number, space = self.made, self.capacity
            self.made += 1
        left = space - length
        if left:
            if not self.bins[left]:
                self.free |= 1 << left
            self.bins[left].append(number)
            self.open += 1
        return number, self.capacity - space


def pack(items: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns, ``length`` among them)."""
    schema = StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    at = items.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        bins = OpenBins(capacity, open_bins)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            sequence = pa.array([first + number for number, _ in placed], pa.int64())
            offset = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sequence, offset], names=schema.names)

    return items.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, with_ids: bool = False
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Null text counts as empty: only the id that ends a document. Long texts are cut, never
    shortened. Repeated rows and null doc_ids are documents of their own; other columns of
    ``docs`` are left out; an empty table gives no pieces. Sequence numbers have gaps between
    tasks. A repeated task packs the same pieces, as it reads them from the same stored files.
    """
    stored = cut_lineage(pieces(docs, vocabulary, capacity, with_ids), "pieces")
    tasks = max(1, -(-stored.count() // _PER_TASK))
    return pack(stored.coalesce(tasks), capacity, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from ``pack_documents(..., with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
