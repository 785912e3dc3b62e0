"""All checks of many raw tables in one scan of each: row checks, orphans, repeated keys.

A row gives one entry per failed row check and one per key that must be looked at elsewhere. Entries
are counted by (slot, key, digest), partially in the tasks that read, so that failed checks shrink to
one row per check and task and a frequent key costs no more than a rare one.

- A reference to a small table is a row check: the row meets the copied keys as it is read.
- A reference to a large table is a slot of its own, in which the rows of both tables count their
  key by value; a key with child rows only is an orphan.
- A key that should be unique is counted by an 8-byte digest. Only rows whose digest repeats are then
  counted by value, in a second scan, so equal digests are never taken for copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.profile import union_all
from tallyhouse.operators.repeats import repeated_in
from tallyhouse.session import fits_broadcast
from tallyhouse.sources.layers import cut_lineage


@dataclass(frozen=True)
class Check:
    """Rows of ``table`` for which the condition holds."""

    table: str
    issue: str
    column: str
    kind: str
    fix: str
    condition: Column


@dataclass(frozen=True)
class Reference:
    """Rows of ``table`` whose key is NULL or no key of ``parent``; the column has one name in both."""

    table: str
    issue: str
    column: str
    kind: str
    fix: str
    parent: str


@dataclass(frozen=True)
class Unique:
    """Surplus rows of ``table`` under key values that occur more than once; NULLs count as equal."""

    table: str
    issue: str
    column: str
    kind: str
    fix: str
    key: tuple[str, ...]


Issue = Check | Reference | Unique
_TEXTS = ("issue", "table_name", "column_name", "issue_class", "fix")


def _entry(slot: int, child: int, parent: int, key: Column | None = None, digest: Column | None = None) -> Column:
    return F.struct(
        F.lit(slot).alias("slot"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        (F.lit(None) if digest is None else digest).cast("long").alias("digest"),
        F.lit(child).alias("child"),
        F.lit(parent).alias("parent"),
    )


def _digest(df: DataFrame, key: tuple[str, ...]) -> Column:
    return F.xxhash64(*[df[c] for c in key])


def entries(tables: dict[str, DataFrame], issues: list[Issue]) -> DataFrame:
    """Columns slot (number of the issue), key, digest, child, parent: what the rows say, one scan
    per table, and one more of each small table that others refer to."""
    copied = {i for i, x in enumerate(issues) if isinstance(x, Reference) and fits_broadcast(tables[x.parent].select(x.column))}
    parts = []
    for name, df in tables.items():
        rows, given = df, []
        for slot, x in enumerate(issues):
            if isinstance(x, Reference) and x.parent == name and slot not in copied:
                given.append(_entry(slot, 0, 1, df[x.column]))
            if x.table != name:
                continue
            if isinstance(x, Check):
                given.append(F.when(x.condition, _entry(slot, 1, 0)))
            elif isinstance(x, Unique):
                given.append(_entry(slot, 0, 1, digest=_digest(df, x.key)))
            elif slot in copied:
                member = f"_member_{slot}"
                known = tables[x.parent].select(F.col(x.column).alias(member)).where(F.col(member).isNotNull()).distinct()
                rows = rows.join(F.broadcast(known), df[x.column] == F.col(member), "left")
                given.append(F.when(F.col(member).isNull(), _entry(slot, 1, 0)))
            else:
                given.append(_entry(slot, 1, 0, df[x.column]))
        if given:
            parts.append(rows.select(F.inline(F.array_compact(F.array(*given)))))
    return union_all(parts)


def _counted(found: DataFrame, issues: list[Issue]) -> DataFrame:
    """One row per slot with its rows, and for unique keys one per repeated digest."""
    keys = found.groupBy("slot", "key", "digest").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    by_value = [i for i, x in enumerate(issues) if isinstance(x, Reference)]
    held = F.col("slot").isin(by_value) & F.col("key").isNotNull() & (F.col("parent") > 0)
    repeated = F.when(F.col("digest").isNotNull() & (F.col("parent") > 1), F.col("digest"))
    rows = F.when(held, 0).otherwise(F.col("child"))
    return keys.groupBy("slot", repeated.alias("digest")).agg(F.sum(rows).alias("n"))


def issue_counts(tables: dict[str, DataFrame], issues: list[Issue]) -> DataFrame:
    """One row per issue: issue, table_name, column_name, issue_class, fix, n.

    Issues that no row shows count 0, and so do those of empty tables. Keys of references are
    compared as text. A table's columns must not begin with ``_member_``.
    """
    counted = cut_lineage(_counted(entries(tables, issues), issues), "audit")
    # One row per issue at most, whatever the tables hold.
    met = {r.slot: r for r in counted.groupBy("slot").agg(F.sum("n").alias("n"), F.count("digest").alias("repeated")).collect()}
    spark = counted.sparkSession
    known, parts = [], []
    for slot, x in enumerate(issues):
        texts = (x.issue, x.table, x.column, x.kind, x.fix)
        if isinstance(x, Unique) and slot in met and met[slot].repeated:
            df = tables[x.table]
            digests = counted.where((F.col("slot") == slot) & F.col("digest").isNotNull()).select("digest")
            copies = repeated_in(df, x.key, digests, _digest(df, x.key))
            surplus = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n"))
            parts.append(surplus.select(*[F.lit(v).alias(c) for c, v in zip(_TEXTS, texts, strict=True)], "n"))
        else:
            known.append((*texts, met[slot].n if slot in met else 0))
    return union_all([spark.createDataFrame(known, ", ".join(f"{c} string" for c in _TEXTS) + ", n long"), *parts])
