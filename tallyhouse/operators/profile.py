"""Profiling of raw tables: counts, duplicates, NULLs, blanks, orphans, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import title_case
from tallyhouse.session import fits_broadcast


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Table name and row count, by name."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    return union_all(counts).orderBy("tbl")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, most frequent first. Pass all columns for whole rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .orderBy(F.desc("n"), *[F.asc_nulls_last(k) for k in keys])
    )


def _profile(df: DataFrame, columns: dict[str, str], prefix: str, test, total: str | None) -> DataFrame:
    counts = [F.count_if(test(F.col(c))).alias(f"{prefix}_{short}") for c, short in columns.items()]
    return df.agg(*([F.count(F.lit(1)).alias(total)] if total else []), *counts)


def null_profile(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows and NULLs per column in one pass; ``columns`` maps a column to its short name."""
    return _profile(df, columns, "null", Column.isNull, "total_rows")


def blank_profile(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Blank strings per column in one pass: missing values that ``IS NULL`` does not see."""
    return _profile(df, columns, "empty", lambda c: c == "", None)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with their row counts.

    Beside a small parent the child is filtered where it lies. Otherwise both sides shrink to one
    row per key before they meet, so a frequent key, present or absent, costs no more than a rare
    one.
    """
    known = parent.select(F.col(parent_key or key).alias(key))
    count = F.count(F.lit(1)).alias("n")
    if fits_broadcast(known):
        return child.select(key).join(F.broadcast(known), key, "left_anti").groupBy(key).agg(count)
    return child.groupBy(key).agg(count).join(known.distinct(), key, "left_anti")


def casing_issues(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Values neither in title case nor in upper case: the ``n`` most frequent."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col(column) != title_case(column)) & (F.col(column) != F.upper(column)))
        .orderBy(F.desc("n"), column)
        .limit(n)
    )


def whitespace_issues(df: DataFrame, column: str) -> DataFrame:
    """Values with spaces at either end, with their row counts."""
    return df.where(F.col(column) != F.trim(column)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def violates(column: str | Column, pattern: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & (c != "") & ~c.rlike(pattern)


def pattern_violations(df: DataFrame, column: str, pattern: str, n: int = 20) -> DataFrame:
    """The first ``n`` non-blank values that do not match."""
    return df.select(column).where(violates(column, pattern)).orderBy(column).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))


# Classes of the issue register.
MEASURE, FOREIGN_KEY, FORMAT = "measure", "foreign key", "format"
