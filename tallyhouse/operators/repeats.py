"""Repeated rows in two passes: digests of all rows first, then only the rows whose digest repeats.

The first pass shuffles an 8-byte digest per different row, counted per task before, so that neither
texts nor a key that many rows carry make it heavy. The second counts the few rows whose digest was met
twice by their values, so two values of one digest are never taken for copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.profile import union_all
from tallyhouse.session import fits_broadcast
from tallyhouse.sources.layers import cut_lineage

Key = tuple[str, ...]


def _digest(df: DataFrame, key: Key) -> Column:
    """Of the key's values; NULLs count as equal, as they do in a group."""
    return F.xxhash64(*[df[c] for c in key])


def repeated_digests(tables: list[tuple[DataFrame, list[Key]]]) -> DataFrame:
    """Columns k and digest: the digests that occur twice or more among the values of key number k, counted
    from 0 over all tables. Each table is scanned once for all its keys."""
    parts, k = [], 0
    for df, keys in tables:
        each = [F.struct(F.lit(k + i).alias("k"), _digest(df, key).alias("digest")) for i, key in enumerate(keys)]
        parts.append(df.select(F.inline(F.array(*each))))
        k += len(keys)
    counted = union_all(parts).groupBy("k", "digest").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1).select("k", "digest")


def _copies(df: DataFrame, key: Key) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _none(df: DataFrame, key: Key) -> DataFrame:
    return df.select(*key, F.lit(0).cast("long").alias("n")).where(F.lit(False))


def repeated_in(df: DataFrame, key: Key, digests: DataFrame, digest: Column) -> DataFrame:
    """Values of ``key`` that occur more than once, with their number n, among the rows whose digest
    is listed; among all rows where the list is too long to be copied."""
    if fits_broadcast(digests):
        df = df.join(F.broadcast(digests), digest == digests["digest"], "left_semi")
    return _copies(df, key)


def repeated_values(tables: list[tuple[DataFrame, list[Key]]]) -> list[DataFrame]:
    """For each key of each table its values that occur more than once, with their number n.

    Keys may hold any type that Spark can group, floating-point numbers excepted (0.0 and -0.0 have
    two digests). Where nothing repeats there is no second pass. Where more digests repeat than may be
    copied to all executors, rows are counted by value at once.
    """
    found = cut_lineage(repeated_digests(tables), "repeated")
    some = {row.k for row in found.select("k").distinct().collect()}  # one row per key at most
    out, k = [], 0
    for df, keys in tables:
        for key in keys:
            digests = found.where(F.col("k") == k).select("digest")
            if k not in some:
                out.append(_none(df, key))
            else:
                out.append(repeated_in(df, key, digests, _digest(df, key)))
            k += 1
    return out


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """As ``profile.duplicate_keys``, in two passes."""
    (copies,) = repeated_values([(df, [tuple(key)])])
    return copies.orderBy(F.desc("n"), *[F.asc_nulls_last(c) for c in key])


def key_violations(tables: list[tuple[str, DataFrame, list[Key]]]) -> DataFrame:
    """Of each key of each table the repeated values and the surplus rows under them, as
    ``validate.pk_violations``; the first pass covers all tables in one job."""
    copies = iter(repeated_values([(df, keys) for _, df, keys in tables]))
    parts = []
    for name, _, keys in tables:
        for key in keys:
            counts = next(copies).agg(
                F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows")
            )
            parts.append(counts.select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "repeated_keys", "surplus_rows"))
    return union_all(parts)
