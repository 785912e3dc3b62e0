"""Checks of the loaded layers: integrity, reconciliation, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.clean import UNKNOWN_DATE_KEY
from tallyhouse.operators.profile import orphans, union_all
from tallyhouse.session import fits_broadcast
from tallyhouse.sources.schemas import Contract


def matched_rows(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Rows of the inner join fact x dimension, from one row per key on either side."""
    left = fact.groupBy(F.col(fk).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    right = dim.groupBy(F.col(pk).alias("k")).agg(F.count(F.lit(1)).alias("m"))
    return left.join(right, "k").agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("n"))


def fk_validation(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Fact rows, and rows that survive the inner join to each dimension; all should be equal.

    ``dims`` maps a label to (dimension, foreign key, dimension key). All small dimensions are
    checked in one pass over the fact, each large one from its key counts.
    """
    small = {label: d for label, d in dims.items() if fits_broadcast(d[0].select(d[2]))}
    rows = fact.select(*[fk for _, fk, _ in small.values()])
    for label, (dim, fk, pk) in small.items():
        members = dim.groupBy(F.col(pk).alias(fk)).agg(F.count(F.lit(1)).alias(f"m_{label}"))
        rows = rows.join(F.broadcast(members), fk, "left")
    counts = rows.agg(
        F.count(F.lit(1)).alias("baseline_fact_rows"),
        *[F.coalesce(F.sum(f"m_{label}"), F.lit(0)).alias(f"matched_{label}") for label in small],
    )
    shown = [F.struct(F.lit(c).alias("check_name"), F.col(c).alias("n")) for c in counts.columns]
    parts = [counts.select(F.inline(F.array(*shown)))]
    for label, (dim, fk, pk) in dims.items():
        if label not in small:
            parts.append(matched_rows(fact, fk, dim, pk).select(F.lit(f"matched_{label}").alias("check_name"), "n"))
    return union_all(parts)


def mart_reconciliation(monthly: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """Mart revenue against dated core sales, and the difference."""
    parts = union_all(
        [
            monthly.agg(F.sum("revenue").cast("decimal(38,2)").alias("mart"), F.lit(None).cast("decimal(38,2)").alias("core")),
            fact_sales.where(F.col("date_fk") != UNKNOWN_DATE_KEY).agg(
                F.lit(None).cast("decimal(38,2)").alias("mart"), F.sum("sales_amount").cast("decimal(38,2)").alias("core")
            ),
        ]
    )
    mart, core = F.max("mart"), F.max("core")
    return parts.agg(
        mart.alias("mart_total_revenue"),
        core.alias("core_total_sales"),
        (F.coalesce(mart, F.lit(0)) - F.coalesce(core, F.lit(0))).cast("decimal(38,2)").alias("difference"),
    )


def pk_violations(df: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    """Repeated key values of one table and the surplus rows under them."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(
        F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows")
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "repeated_keys", "surplus_rows")


def _unpivot(counts: DataFrame, table: str, labels: list[tuple[str, ...]], names: list[str]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            *[F.lit(value).alias(name) for name, value in zip(names, label, strict=True)],
            F.col(f"c{i}").alias("n"),
        )
        for i, label in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*rows)))


def not_null_violations(df: DataFrame, table: str, contract: Contract) -> DataFrame:
    """NULLs in each required column, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(contract.not_null)])
    return _unpivot(counts, table, [(c,) for c in contract.not_null], ["column_name"])


def domain_violations(df: DataFrame, table: str, contract: Contract) -> DataFrame | None:
    """Values too long for their text column or out of their decimal range, in one scan."""
    checks = [((c, f"length <= {n}"), F.length(c) > n) for c, n in contract.max_length.items()]
    checks += [((c, t), F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) for c, t in contract.decimals.items()]
    if not checks:
        return None
    counts = df.agg(*[F.count_if(test).alias(f"c{i}") for i, (_, test) in enumerate(checks)])
    return _unpivot(counts, table, [label for label, _ in checks], ["column_name", "rule"])


def fk_violations(fact: DataFrame, table: str, fk: str, dim: DataFrame, dim_table: str, pk: str) -> DataFrame:
    """Distinct foreign keys without a member, and the rows that carry them."""
    missing = orphans(fact, dim, fk, pk)
    return missing.agg(
        F.count(F.lit(1)).alias("missing_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(fk).alias("column_name"),
        F.lit(f"{dim_table}.{pk}").alias("references"),
        "missing_keys",
        "rows",
    )


#: Of each foreign key: the table it refers to, that table's key, and its name in reports.
Parents = dict[str, tuple[DataFrame, str, str]]


def missing_members(fact: DataFrame, parents: Parents) -> DataFrame:
    """Foreign keys without a member, for all foreign keys in one scan of the fact: column_name, key (as
    text), rows. Rows are counted per key before the shuffle, so a key that half of the rows carry is one
    row of it; NULLs refer to nothing."""
    types = {*[fact.schema[fk].dataType for fk in parents], *[dim.schema[pk].dataType for dim, pk, _ in parents.values()]}
    kind = "long" if all(isinstance(t, T.IntegralType) for t in types) else "string"  # numbers are counted as numbers
    names = F.array(*[F.lit(fk) for fk in parents])
    each = [F.struct(F.lit(i).alias("_i"), F.col(fk).cast(kind).alias("key")) for i, fk in enumerate(parents)]
    carried = fact.select(F.inline(F.array(*each))).where("key IS NOT NULL")
    counted = carried.groupBy("_i", "key").agg(F.count(F.lit(1)).alias("rows"))
    members = union_all([dim.select(F.lit(i).alias("_i"), F.col(pk).cast(kind).alias("key")) for i, (dim, pk, _) in enumerate(parents.values())])
    missing = counted.join(members, ["_i", "key"], "left_anti")
    return missing.select(F.get(names, F.col("_i")).alias("column_name"), F.col("key").cast("string").alias("key"), "rows")


def fk_violations_of(fact: DataFrame, table: str, parents: Parents) -> DataFrame:
    """Per foreign key the distinct keys without a member and the rows that carry them, as ``fk_violations``."""
    missing = missing_members(fact, parents)
    of = [F.col("column_name") == fk for fk in parents]
    counts = missing.agg(
        *[F.count_if(own).alias(f"k{i}") for i, own in enumerate(of)],
        *[F.coalesce(F.sum(F.when(own, F.col("rows"))), F.lit(0)).alias(f"n{i}") for i, own in enumerate(of)],
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(fk).alias("column_name"), F.lit(label).alias("references"),
            F.col(f"k{i}").alias("missing_keys"), F.col(f"n{i}").alias("rows"),
        )
        for i, (fk, (_, _, label)) in enumerate(parents.items())
    ]
    return counts.select(F.inline(F.array(*rows)))


def broken_contract(
    df: DataFrame, contract: Contract, unique_key: bool = True, parents: Parents | None = None, lengths: bool = False
) -> list[str]:
    """What a load must not publish: wrong types; NULLs and amounts out of range (with ``lengths`` also
    texts longer than their column, which otherwise ``domain_violations`` reports), in one scan;
    repeated keys (``unique_key=False`` where the writer makes them unique); and foreign keys that
    ``parents`` has no member for, in one more scan."""
    wrong = contract_types(df, contract)
    if wrong:
        return wrong
    tests = [(f"NULL in {c}", F.col(c).isNull()) for c in contract.not_null]
    tests += [(f"{c} out of {t}", F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) for c, t in contract.decimals.items()]
    if lengths:
        tests += [(f"{c} longer than {n}", F.length(c) > n) for c, n in contract.max_length.items()]
    found = df.agg(*[F.count_if(test).alias(f"c{i}") for i, (_, test) in enumerate(tests)]).first() if tests else ()
    wrong = [f"{n} rows with {what}" for n, (what, _) in zip(found, tests, strict=True) if n]
    if unique_key:
        repeated = df.groupBy(contract.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
        wrong += [f"{repeated} repeated keys in {contract.key}"] if repeated else []
    if parents:
        gaps = missing_members(df, parents).groupBy("column_name").agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("keys"), F.min("key").alias("key"))
        wrong += [
            f"{g.n} rows whose {g.column_name} has no member in {parents[g.column_name][2]}: {g.key}" + (f" and {g['keys'] - 1} more" if g["keys"] > 1 else "")
            for g in sorted(gaps.collect())  # a row per foreign key at most
        ]
    return wrong


def contract_types(df: DataFrame, contract: Contract) -> list[str]:
    """Columns whose name or type differs from the contract, by metadata only."""
    actual = dict(df.dtypes)
    return [f"{c}: {actual.get(c)} instead of {t}" for c, t in contract.columns.items() if actual.get(c) != t]
