"""Cleaning and typing of raw text columns.

Every raw column is text and a missing value is ``''``. The typed forms come in two modes:
``strict`` fails the job on text that is not a value of the type (what a database load does),
``lenient`` yields NULL so that the caller can split such rows out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NUMBER_PATTERN = r"\A\d+(\.\d+)?\z"
TIMESTAMP_PATTERN = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
DATE_TEXT_PATTERN = r"\A\d{4}-\d{2}-\d{2}(?:[ T](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?)?\z"
UNKNOWN_CATEGORY = "Unknown Category"
UNKNOWN_DATE_KEY = 19000101
UNKNOWN_KEY = -1

# Unbounded numeric text is read with this type before it is rounded to a column's own scale.
WIDE_DECIMAL = "decimal(20,6)"
SIZE_DECIMAL = "decimal(18,4)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(_col(c), F.lit(""))


def null_to_blank(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def _typed(text: Column, value: Column, mode: str, what: str) -> Column:
    if mode == "lenient":
        return value
    if mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    failure = F.raise_error(F.concat(F.lit(f"not a {what}: "), text))
    return F.coalesce(value, F.when(text.isNotNull(), failure))


def text_to_decimal(c: str | Column, type_name: str = WIDE_DECIMAL, mode: str = "strict") -> Column:
    """A decimal. The two wide types stand for numbers of any length, so text with more digits than they
    keep is no value of theirs; a column's own type rounds, as a load into that column does."""
    text = blank_to_null(c)
    value = text.try_cast(type_name)
    if type_name in (WIDE_DECIMAL, SIZE_DECIMAL):
        scale = int(type_name.rstrip(")").split(",")[1])
        lost = text.rlike(rf"\.\d{{{scale}}}\d*[1-9]") | F.coalesce(text.try_cast("decimal(38,18)") != value, F.lit(False))
        value = F.when(~lost, value)
        return _typed(text, value, mode, f"number of at most {scale} decimals")
    return _typed(text, value, mode, "number")


def text_to_int(c: str | Column, mode: str = "strict") -> Column:
    text = blank_to_null(c)
    return _typed(text, text.try_cast("int"), mode, "whole number")


def text_to_date(c: str | Column, mode: str = "strict") -> Column:
    """Calendar date of a timestamp text; the time of day is dropped.

    The pattern comes first because a plain cast to date also accepts trailing junk.
    """
    text = blank_to_null(c)
    value = F.when(text.rlike(DATE_TEXT_PATTERN), F.substring(text, 1, 10).try_cast("date"))
    return _typed(text, value, mode, "date")


def required(c: str | Column, what: str) -> Column:
    """NOT NULL at load time: a missing value fails the job."""
    return F.coalesce(_col(c), F.raise_error(F.lit(f"missing value in {what}")))


def within(c: str | Column, type_name: str) -> Column:
    """Cast to a column's own type; a value out of its range fails the job, ANSI mode or not."""
    value = _col(c)
    failure = F.raise_error(F.concat(F.lit(f"out of range of {type_name}: "), value.cast("string")))
    return F.coalesce(value.try_cast(type_name), F.when(value.isNotNull(), failure))


def title_case(c: str | Column) -> Column:
    """Upper-case the first letter after every non-alphanumeric character, lower-case the rest.

    Spark's ``initcap`` only starts a word after a blank (``d'oeste`` -> ``D'oeste``).
    """
    pieces = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    capitalised = F.transform(
        pieces, lambda t: F.concat(F.upper(F.substr(t, F.lit(1), F.lit(1))), F.substr(t, F.lit(2)))
    )
    return F.array_join(capitalised, "")


def clean_city(c: str | Column) -> Column:
    return title_case(F.trim(_col(c)))


def category_or_unknown(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(UNKNOWN_CATEGORY))


def key_or_unknown(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(UNKNOWN_KEY).cast("long"))


def date_key_or_unknown(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(UNKNOWN_DATE_KEY))
