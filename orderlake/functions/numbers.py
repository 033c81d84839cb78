"""Money sums, means, ratios and rounding with one result type each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
MONEY_TOTAL = "decimal(38,2)"


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def money_sum(amount: Column) -> Column:
    """Exact total, null over no values."""
    return F.sum(amount).cast(MONEY_TOTAL)


def mean(amount: Column) -> Column:
    """Mean as a double, from the exact total."""
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null if the denominator is zero or either side is null."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double, halves away from zero, in double arithmetic."""
    scale = 10.0**digits
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale
