"""Calendar expressions: smart keys, names, flags, day differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.clean import _col


def date_key(c: str | Column) -> Column:
    """YYYYMMDD as int."""
    d = _col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(year: str | Column, month: str | Column) -> Column:
    """YYYYMM as int."""
    return _col(year) * 100 + _col(month)


def month_of_date_key(c: str | Column) -> Column:
    return F.floor(_col(c) / 100).cast("int")


def month_start(c: str | Column) -> Column:
    """First day of a YYYYMM month."""
    m = _col(c)
    return F.make_date(F.floor(m / 100).cast("int"), (m % 100).cast("int"), F.lit(1))


def is_weekday(c: str | Column) -> Column:
    return F.when(F.weekday(_col(c)).isin(5, 6), F.lit(False)).otherwise(F.lit(True))


def day_name(c: str | Column) -> Column:
    return F.date_format(_col(c), "EEEE")


def month_name(c: str | Column) -> Column:
    return F.date_format(_col(c), "MMMM")


def days_between(end: str | Column, start: str | Column) -> Column:
    """Whole calendar days; NULL when either side is missing, negative when out of order."""
    return F.datediff(_col(end), _col(start))
