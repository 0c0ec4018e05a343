"""Number expressions: casts, rounding, profit ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: half-width of the interval shown beside a predicted revenue.
INTERVAL_MARGIN = 1.99 * 5451066


def as_id(value: Column) -> Column:
    """Ids may arrive as floats; they are stored as nullable longs."""
    return value.cast("bigint")


def as_category(value: Column) -> Column:
    return value.cast("string")


def to_number(text: Column) -> Column:
    """Lenient: text that is no number gives null."""
    return text.try_cast("double")


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def round_half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def profit(revenue: Column, budget: Column) -> Column:
    return revenue - budget


def return_on_budget(revenue: Column, budget: Column) -> Column:
    """Profit per unit of budget; null, never an error, where the budget is 0 or null."""
    return (revenue - budget) / zero_to_null(budget)


def international(revenue: Column, domestic: Column) -> Column:
    return revenue - domestic


def flag_unless_false(value: Column) -> Column:
    """0 only for ``False``; true and null are both 1."""
    return F.when(~value, F.lit(0)).otherwise(F.lit(1))


def yes_no(value: Column) -> Column:
    return F.when(value == "Yes", F.lit(1)).otherwise(F.lit(0))


def interval_low(value: Column, margin: float = INTERVAL_MARGIN) -> Column:
    return F.bround(F.greatest(F.lit(1.0), value - F.lit(margin)), 2)


def interval_high(value: Column, margin: float = INTERVAL_MARGIN) -> Column:
    return F.bround(value + F.lit(margin), 2)
