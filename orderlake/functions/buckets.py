"""Lookup rules that turn a number or a code into a label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product weight in grams, lower bound (inclusive) of each bucket above the first.
WEIGHT_BUCKETS = (
    (None, "XS (<0.5kg)"),
    (500, "S (0.5–2kg)"),
    (2000, "M (2–5kg)"),
    (5000, "L (5–15kg)"),
    (15000, "XL (15kg+)"),
)
WEIGHT_MISSING = "unknown"

# Number of instalments, lowest count of each bucket.
INSTALLMENT_BUCKETS = (
    (1, "1 (single)"),
    (2, "2-3"),
    (4, "4-6"),
    (7, "7-12"),
    (13, "13+"),
)
INSTALLMENT_MISSING = "unknown"

# The 27 states of Brazil by region.
REGIONS = {
    "Southeast": ("SP", "RJ", "MG", "ES"),
    "South": ("PR", "SC", "RS"),
    "Center-West": ("GO", "MT", "MS", "DF"),
    "Northeast": ("BA", "PE", "CE", "MA", "PB", "RN", "AL", "SE", "PI"),
    "North": ("AM", "PA", "RO", "AC", "RR", "AP", "TO"),
}
REGION_MISSING = "Unknown"


def by_lower_bound(value: Column, buckets, missing: str) -> Column:
    """Label of the highest bucket whose lower bound `value` reaches; `missing` if there is none."""
    label = None
    for bound, name in reversed(buckets):
        reached = value.isNotNull() if bound is None else value >= bound
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return label.otherwise(missing)


def weight_bucket(grams: Column) -> Column:
    return by_lower_bound(grams, WEIGHT_BUCKETS, WEIGHT_MISSING)


def installment_bucket(count: Column) -> Column:
    return by_lower_bound(count, INSTALLMENT_BUCKETS, INSTALLMENT_MISSING)


def region(state: Column) -> Column:
    label = F.when(state.isNull(), REGION_MISSING)
    for name, states in REGIONS.items():
        label = label.when(state.isin(*states), name)
    return label.otherwise(REGION_MISSING)
