"""Measures and the aggregates each one allows.

An additive measure may be summed over any dimension. A non-additive one (a ratio, a lag per
order) must be averaged or recomputed from additive parts at the level shown.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COST_RATIO = Decimal("0.65")
MONEY = "decimal(10,2)"
MONTHLY_MONEY = "decimal(12,2)"


def estimated_cost(price: Column, ratio: Decimal = COST_RATIO) -> Column:
    return F.round(price * F.lit(ratio), 2)


def estimated_profit(price: Column, ratio: Decimal = COST_RATIO) -> Column:
    """Rounded on its own, so cost + profit can be one cent above the price."""
    return F.round(price - price * F.lit(ratio), 2)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL over zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


@dataclass(frozen=True)
class Measure:
    name: str
    additive: bool
    ratio_of: tuple[str, str] | None = None  # (numerator, denominator), both additive


MEASURES = {
    m.name: m
    for m in (
        Measure("quantity", True),
        Measure("price", True),
        Measure("freight_value", True),
        Measure("sales_amount", True),
        Measure("product_cost", True),
        Measure("revenue", True),
        Measure("cost", True),
        Measure("profit", True),
        Measure("profit_margin", False, ("profit", "revenue")),
        Measure("unit_price", False, ("revenue", "quantity")),
        Measure("days_to_approve", False),
        Measure("days_to_ship", False),
        Measure("days_to_deliver", False),
    )
}


class NotAdditive(ValueError):
    """A sum was asked of a measure that must not be summed."""


def total(name: str) -> Column:
    if not MEASURES[name].additive:
        raise NotAdditive(f"{name} is not additive: average it or recompute it")
    return F.sum(name)


def average(name: str) -> Column:
    if MEASURES[name].ratio_of:
        raise NotAdditive(f"{name} is a ratio: recompute it from its sums")
    return F.avg(name)


def recomputed(name: str) -> Column:
    """Ratio of sums at the current grouping."""
    parts = MEASURES[name].ratio_of
    if parts is None:
        raise ValueError(f"{name} is not a ratio of additive measures")
    return safe_ratio(total(parts[0]), total(parts[1]))


def report(df: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Group and show measures, each in the one way it allows."""
    shown = []
    for name in measures:
        measure = MEASURES[name]
        if measure.additive:
            shown.append(total(name).alias(name))
        elif measure.ratio_of:
            shown.append(recomputed(name).alias(name))
        else:
            shown.append(average(name).alias(f"avg_{name}"))
    return df.groupBy(*by).agg(*shown)
