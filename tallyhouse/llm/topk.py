"""Exact top-k by inner product with pivot-table elimination.

Vectors are turned into whole numbers, floor(256 * x). A table of the distances from every vector to
the pivots is computed once. By the triangle inequality the largest difference between two rows of
the table is a lower bound of the two vectors' distance, and with their lengths an upper bound of
their inner product: (|x|^2 + |y|^2 - bound^2) / 2. A query's candidates are evaluated in the order
of that bound until the next bound is below the k-th best score, so nothing is approximate.

Candidates and queries are packed into blocks. Every block of queries meets every block of
candidates, as the query set is given; a task holds one block of either at a time. Blocks meet by a
shuffle and never pass the driver, however small their files are; what the driver gets is the sample
that pivots are chosen from, of a size that does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, numbered, small_batches

SCALE = 256
PIVOTS = 32
PIVOT_SAMPLE = 2000  # rows that the pivots are chosen from
_CANDIDATES, _QUERIES = 4096, 1024  # vectors in a block
_AT_ONCE = 64  # queries whose bounds are held together
_EXACT = float(1 << 53)


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there, and all of whose components are finite numbers."""
    bad = F.exists(F.col(column), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(False)))


def whole(column: str = "embedding") -> Column:
    """The components as whole numbers, kept as doubles."""

    def down(x: Column) -> Column:
        near = F.rint(x * SCALE)
        return F.when(near > x * SCALE, near - 1).otherwise(near)

    return F.transform(F.col(column).cast("array<double>"), down)


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Pivots far from each other: each is the vector farthest from those chosen so far."""
    if not len(vectors):
        return vectors[:0]
    chosen = [0]
    nearest = np.full(len(vectors), np.inf)
    while len(chosen) < min(count, len(vectors)):
        nearest = np.minimum(nearest, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(nearest.argmax()))
    return vectors[chosen]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One row per pivot."""
    out = np.empty((len(pivots), len(vectors)))
    for i, p in enumerate(pivots):
        out[i] = np.sqrt(((vectors - p) ** 2).sum(axis=1))
    return out


def _blocks(size: int, width: int, pivots: np.ndarray):
    """Packs rows (row, vec_id, v) into blocks: number of rows, ids, and the bytes of the vectors
    and of their part of the pivot table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[int] = []
        ids: list[int | None] = []
        vectors: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            v = np.zeros((len(rows), width))
            for i, x in enumerate(vectors):
                v[i, : len(x)] = x
            table = _distances(v, pivots)
            longs = pa.list_(pa.int64())
            columns = [pa.array([rows[0]]), pa.array([rows], longs), pa.array([ids], longs), pa.array([v.tobytes()]), pa.array([table.tobytes()])]
            return pa.RecordBatch.from_arrays(columns, names=["block", "rows", "ids", "vectors", "pivot_table"])

        for batch in batches:
            for r, i, v in zip(*[batch.column(k).to_pylist() for k in range(2)], batch.column(2), strict=True):
                rows.append(r)
                ids.append(i)
                vectors.append(v.values.to_numpy(zero_copy_only=False))
                if len(rows) == size:
                    yield block()
                    rows, ids, vectors = [], [], []
        if rows:
            yield block()

    return run


_BLOCK = "block long, rows array<long>, ids array<long>, vectors binary, pivot_table binary"


def _likely(source: DataFrame, rows: int, wanted: int) -> DataFrame:
    """Rows (``rows`` in all) among which the first ``wanted`` in the order of their hashes are. Each task
    sends its first ``wanted`` to the driver, so of a table in many tasks only these rows are asked."""
    share = 4 * wanted + 100  # so many more that the first are left out by no chance worth naming
    if rows <= share:
        return source
    return source.where(F.xxhash64("row") < (share << 64) // rows - (1 << 63))


def _meet(x: DataFrame, q: DataFrame, groups: int) -> DataFrame:
    """Each block of candidates with each block of queries. Queries are repeated for each of ``groups``, which
    Spark's estimate of their size does not see; the hint keeps it from copying them by way of the driver."""
    names = {"rows": "rows", "ids": "ids", "vectors": "vectors", "pivot_table": "table"}
    left = x.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"), *[F.col(a).alias(f"x_{b}") for a, b in names.items()])
    right = q.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"), *[F.col(a).alias(f"q_{b}") for a, b in names.items()])
    return left.join(right.hint("merge"), "g").drop("g")


def _scores(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    return x @ q if exact else (x.astype(object) * [int(v) for v in q]).sum(axis=1)


def _best(width: int, k: int):
    """The best k of a block of candidates for each query of a block, those that cannot reach the
    best k any more left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[int, float] = {}  # the k-th best score of a query in the blocks so far
        for batch in batches:
            for line in batch.to_pylist():
                x = np.frombuffer(line["x_vectors"]).reshape(-1, width)
                q = np.frombuffer(line["q_vectors"]).reshape(-1, width)
                table_x = np.frombuffer(line["x_table"]).reshape(-1, len(x))
                table_q = np.frombuffer(line["q_table"]).reshape(-1, len(q))
                rows_x, ids_x = np.array(line["x_rows"]), line["x_ids"]
                order_x = np.array([np.inf if i is None else i for i in ids_x])
                square_x, square_q = (x * x).sum(axis=1), (q * q).sum(axis=1)
                exact = width * np.abs(x).max(initial=1) * np.abs(q).max(initial=1) < _EXACT
                out: list[tuple] = []
                for first in range(0, len(q), _AT_ONCE):
                    last = min(first + _AT_ONCE, len(q))
                    lower = np.zeros((last - first, len(x)))
                    for p in range(len(table_x)):
                        np.maximum(lower, np.abs(table_q[p, first:last, None] - table_x[p]), out=lower)
                    both = square_q[first:last, None] + square_x
                    bound = (both - lower * lower) / 2 + 1e-9 * both + 1.0  # more than rounding can take away
                    for i in range(first, last):
                        row, limit = line["q_rows"][i], bound[i - first]
                        floor = reached.get(row, -np.inf)
                        could = np.flatnonzero((limit >= floor) & (rows_x != row))
                        could = could[np.argsort(-limit[could], kind="stable")]
                        best: list[tuple] = []
                        at, step = 0, 4 * k
                        while at < len(could) and limit[could[at]] >= floor:
                            now = could[at : at + step]
                            score = _scores(x[now], q[i], exact)
                            good = np.flatnonzero(score >= floor)
                            best = sorted(best + [(-score[j], order_x[now[j]], now[j]) for j in good])[:k]
                            if len(best) == k:
                                floor = max(floor, float(-best[-1][0]))
                            at, step = at + step, step * 2
                        reached[row] = floor
                        out += [(row, line["q_ids"][i], int(rows_x[j]), ids_x[j], int(-s)) for s, _, j in best]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["query_row", "query_id", "row", "vec_id", "score"]
                )

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, pivots: int = PIVOTS, pivot_sample: int = PIVOT_SAMPLE) -> DataFrame:
    """The ``k`` highest inner products of each row that ``queries`` selects with the other rows.

    Returns query_id, rank, vec_id, score; ties go to the smaller vec_id (null last, then by row).
    Vectors that are null or hold null or non-finite components take no part; shorter vectors are
    filled up with zeros. Repeated rows are rows of their own and candidates of each other. A row
    with a null vec_id is a candidate, but no query. Pivots come from a sample of bounded size;
    they only affect speed.
    """
    spark = vectors.sparkSession
    source, row = numbered(vectors, "vectors")
    source = usable(source).select(F.col(row).alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole().alias("v"), queries.alias("asks"))
    width, count = source.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    width = width or 0
    sample = _likely(source, count, pivot_sample).orderBy(F.xxhash64("row"), "row").limit(pivot_sample).select("v").collect()
    matrix = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        matrix[i, : len(r[0])] = r[0]
    chosen = choose_pivots(matrix, pivots)

    rows = source.select("row", "vec_id", "v")
    x = cut_lineage(rows.mapInArrow(_blocks(_CANDIDATES, width, chosen), _BLOCK), "candidates")
    q = cut_lineage(rows.where(source["asks"]).mapInArrow(_blocks(_QUERIES, width, chosen), _BLOCK), "queries")
    groups = max(1, min(x.count(), 4 * spark.sparkContext.defaultParallelism))
    with small_batches(spark, 1):
        found = cut_lineage(_meet(x, q, groups).mapInArrow(_best(width, k), "query_row long, query_id long, row long, vec_id long, score long"), "found")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
