"""Comparison of a Spark result with the same query in DuckDB: as bags of rows by column name."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("dec", value)
    if isinstance(value, float):
        return ("f", f"{value:.12g}")
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """Rows of the Spark result, and what differs (blank when nothing does)."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    rows = df.collect()
    if sorted(expected_columns) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} instead of {sorted(expected_columns)}"
    got, expected = bag(df.columns, rows), bag(expected_columns, cursor.fetchall())
    if got == expected:
        return len(rows), ""
    extra, missing = got - expected, expected - got
    return len(rows), (
        f"{sum(extra.values())} rows too many, {sum(missing.values())} missing; "
        f"e.g. {list(extra)[:2]} / {list(missing)[:2]}"
    )
