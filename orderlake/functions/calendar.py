"""Calendar arithmetic on wall-clock days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")

# One step of each grain, for `sequence`.
STEPS = {
    "day": "interval 1 day",
    "week": "interval 7 day",
    "month": "interval 1 month",
    "quarter": "interval 3 month",
    "year": "interval 1 year",
}


def days_between(start: Column, end: Column) -> Column:
    """Midnights passed from start to end: 23:59 to 00:01 is one day. Null if either is null."""
    return F.date_diff(end.cast("date"), start.cast("date")).cast("bigint")


def period_start(day: Column, grain: str) -> Column:
    """First day of the week (Monday), month, quarter or year that holds `day`."""
    if grain not in GRAINS:
        raise ValueError(f"unknown time grain {grain!r}; known: {', '.join(GRAINS)}")
    return day if grain == "day" else F.date_trunc(grain, day).cast("date")


def day_of_week(day: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return (F.dayofweek(day) - 1).cast("bigint")
