"""Landing of raw CSV files as all-text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.clean import null_to_blank
from tallyhouse.sources.multiline import read_split_csv
from tallyhouse.sources.schemas import MULTILINE_TABLES, RAW_SCHEMAS

# RFC 4180: fields in double quotes, a quote inside doubled.
_CSV = {"header": True, "quote": '"', "escape": '"'}
ROWS_PER_GZIP = 500_000


def load_raw(spark: SparkSession, name: str, path: str, multiline: bool | None = None) -> DataFrame:
    """Read one raw table as it is: header row, every column text, blank fields as ``''``.

    ``multiline`` says whether quoted fields may hold line breaks; by default only the tables with
    free text. Either way a file is read in splits, by as many tasks as its size asks for.
    """
    if multiline is None:
        multiline = name in MULTILINE_TABLES
    if multiline:
        return read_split_csv(spark, path, RAW_SCHEMAS[name])
    rows = (
        spark.read.schema(RAW_SCHEMAS[name])
        .options(**_CSV, enforceSchema=False, mode="FAILFAST")
        .csv(path)
    )
    # The reader gives NULL for an unquoted blank, whatever nullValue says.
    return rows.select(*[null_to_blank(c).alias(c) for c in rows.columns])


def write_raw(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Write a raw table as the CSV that ``load_raw`` reads. With ``gzip`` files are compressed, which leaves
    each to one reading task, and so hold no more than ``ROWS_PER_GZIP`` rows; for tables of short fields."""
    packed = {"compression": "gzip", "maxRecordsPerFile": ROWS_PER_GZIP} if gzip else {}
    df.write.mode("overwrite").options(
        **_CSV, **packed, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def flatten_newlines(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each run of line breaks by one space, so that a record fits on one line."""
    return df.withColumns({c: F.regexp_replace(c, r"[\r\n]+", " ") for c in columns})


def peek(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows in column order."""
    return df.orderBy(*df.columns).limit(n)
