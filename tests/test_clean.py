from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.functions import clean, dates
from tallyhouse.functions.measures import (
    MEASURES,
    NotAdditive,
    estimated_cost,
    estimated_profit,
    recomputed,
    report,
    safe_ratio,
    total,
)
from tallyhouse.operators.profile import violates


def one(spark, value, expression, type_name="string"):
    return spark.createDataFrame([(value,)], f"c {type_name}").select(expression(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (" santa barbara d'oeste ", "Santa Barbara D'Oeste"),
        ("mogi-guacu", "Mogi-Guacu"),
        ("SAO PAULO", "Sao Paulo"),
        ("são joão", "São João"),
        ("3rd street", "3rd Street"),
        ("nation_7-asia", "Nation_7-Asia"),
        ("\ttab kept", "\tTab Kept"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_city(spark, raw, expected):
    assert one(spark, raw, clean.clean_city) == expected


@pytest.mark.parametrize(
    "raw, bad",
    [("12", False), ("12.5", False), ("12\n", True), ("12.", True), ("-1", True), ("", False), (None, False), ("R$1", True)],
)
def test_number_pattern(spark, raw, bad):
    assert one(spark, raw, lambda c: violates(c, clean.NUMBER_PATTERN)) is bad


@pytest.mark.parametrize(
    "raw, bad",
    [
        ("2017-10-02 10:00:00", False),
        ("2017-10-02 10:00:00\n", True),
        ("2017-10-02", True),
        ("2017-10-02 junk", True),
        ("", False),
    ],
)
def test_timestamp_pattern(spark, raw, bad):
    assert one(spark, raw, lambda c: violates(c, clean.TIMESTAMP_PATTERN)) is bad


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2017-10-02 23:59:59", date(2017, 10, 2)),
        ("2017-10-02", date(2017, 10, 2)),
        ("", None),
        (None, None),
    ],
)
def test_text_to_date(spark, raw, day):
    assert one(spark, raw, clean.text_to_date) == day


@pytest.mark.parametrize("raw", ["2017-10-02 junk", "2017-02-30 10:00:00", "02/10/2017", "2017-10-02 25:00:00"])
def test_bad_date_fails_or_is_null(spark, raw):
    with pytest.raises(PySparkException, match="not a date"):
        one(spark, raw, clean.text_to_date)
    assert one(spark, raw, lambda c: clean.text_to_date(c, "lenient")) is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_number_fails_with_and_without_ansi(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="not a number"):
            one(spark, "12,50", clean.text_to_decimal)
        with pytest.raises(PySparkException, match="not a whole number"):
            one(spark, "1.5x", clean.text_to_int)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert one(spark, "12,50", lambda c: clean.text_to_decimal(c, mode="lenient")) is None
    assert one(spark, "", clean.text_to_decimal) is None


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        clean.text_to_int(F.lit("1"), mode="loose")


def test_half_cent_rounds_up_twice(spark):
    price = lambda c: clean.text_to_decimal(c)
    cost = one(spark, "9.90", lambda c: estimated_cost(price(c)))
    profit = one(spark, "9.90", lambda c: estimated_profit(price(c)))
    assert (cost, profit) == (Decimal("6.44"), Decimal("3.47"))


def test_calendar_parts(spark):
    row = (
        spark.createDataFrame([(date(2017, 5, 6), date(2017, 10, 2))], "d date, e date")
        .select(
            dates.date_key("d"),
            dates.is_weekday("d"),
            dates.is_weekday("e"),
            dates.day_name("d"),
            dates.month_name("d"),
            dates.month_start(F.lit(201705)),
            dates.month_of_date_key(F.lit(20170506)),
        )
        .first()
    )
    assert tuple(row) == (20170506, False, True, "Saturday", "May", date(2017, 5, 1), 201705)


def test_days_between_counts_calendar_days(spark):
    row = (
        spark.createDataFrame(
            [("2017-10-02 23:59:00", "2017-10-03 00:01:00", "")], "placed string, approved string, shipped string"
        )
        .select(*[clean.text_to_date(c).alias(c) for c in ("placed", "approved", "shipped")])
        .select(
            dates.days_between("approved", "placed"),
            dates.days_between("placed", "approved"),
            dates.days_between("shipped", "approved"),
        )
        .first()
    )
    assert tuple(row) == (1, -1, None)


def test_ratio_over_zero_is_null(spark):
    assert one(spark, 0, lambda c: safe_ratio(F.lit(5), c), "int") is None


def test_sum_of_non_additive_measure_is_refused():
    for name, measure in MEASURES.items():
        if not measure.additive:
            with pytest.raises(NotAdditive):
                total(name)
    with pytest.raises(ValueError):
        recomputed("days_to_ship")


def test_report_recomputes_ratios_and_averages_lags(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 1.0, 2), ("a", 30.0, 9.0, None), ("b", 0.0, 0.0, 4)],
        "g string, revenue double, profit double, days_to_ship int",
    )
    rows = {r["g"]: r for r in report(df, ["g"], ["revenue", "profit_margin", "days_to_ship"]).collect()}
    assert rows["a"]["profit_margin"] == 0.25 and rows["a"]["avg_days_to_ship"] == 2.0
    assert rows["b"]["profit_margin"] is None
