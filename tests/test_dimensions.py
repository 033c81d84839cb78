"""Calendar, labels, keys and the customer collapse."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.functions import buckets
from orderlake.functions.keys import surrogate_key
from orderlake.functions.numbers import ratio, round_half_away
from orderlake.operators import dimensions


def dates(spark, start, end):
    rows = dimensions.dim_dates(dimensions.date_range(spark, start, end)).orderBy("date_key").collect()
    return {r.date_key.isoformat(): r for r in rows}


def test_default_calendar_has_its_last_day(spark):
    days = dimensions.dim_dates(dimensions.date_range(spark))
    assert days.count() == 1096
    assert days.agg(F.max("date_key")).first()[0] == dt.date(2018, 12, 31)
    assert dimensions.time_spine(days).columns == ["date_day"]


def test_calendar_attributes(spark):
    day = dates(spark, "2016-01-01", "2017-01-01")
    first = day["2016-01-01"]
    assert (first.iso_week, first.day_of_week, first.is_weekend) == (53, 5, False)
    assert (first.year_month, first.month_name, first.day_name) == ("2016-01", "January", "Friday")
    assert first.full_date == dt.datetime(2016, 1, 1)
    sunday = day["2016-01-03"]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.week_start) == (0, True, dt.date(2015, 12, 28))
    assert day["2016-01-02"].day_of_week == 6 and day["2016-01-04"].week_start == dt.date(2016, 1, 4)
    last = day["2016-12-31"]
    assert (last.day_of_year, last.quarter, last.quarter_start) == (366, 4, dt.date(2016, 10, 1))
    assert (last.month_start, last.year_start) == (dt.date(2016, 12, 1), dt.date(2016, 1, 1))
    assert "2016-02-29" in day and len(day) == 366


def test_empty_calendar(spark):
    assert dates(spark, "2016-01-01", "2016-01-01") == {}


@pytest.mark.parametrize(
    "grams, label",
    [
        ("499.99", "XS (<0.5kg)"),
        ("500", "S (0.5–2kg)"),
        ("1999.99", "S (0.5–2kg)"),
        ("2000", "M (2–5kg)"),
        ("4999.99", "M (2–5kg)"),
        ("5000", "L (5–15kg)"),
        ("14999.99", "L (5–15kg)"),
        ("15000", "XL (15kg+)"),
        (None, "unknown"),
    ],
)
def test_weight_buckets(spark, grams, label):
    df = spark.createDataFrame([(None if grams is None else Decimal(grams),)], "g decimal(10,2)")
    assert df.select(buckets.weight_bucket(F.col("g"))).first()[0] == label


def test_installment_buckets(spark):
    labels = {
        None: "unknown", -1: "unknown", 0: "unknown", 1: "1 (single)", 2: "2-3", 3: "2-3", 4: "4-6", 6: "4-6",
        7: "7-12", 12: "7-12", 13: "13+", 99: "13+",
    }
    df = spark.createDataFrame([(n,) for n in labels], "n int")
    assert dict(df.select("n", buckets.installment_bucket(F.col("n"))).collect()) == labels


def test_regions(spark):
    states = {s: name for name, group in buckets.REGIONS.items() for s in group}
    assert len(states) == 27
    states |= {"ZZ": "Unknown", None: "Unknown", "sp": "Unknown"}
    df = spark.createDataFrame([(s,) for s in states], "s string")
    assert dict(df.select("s", buckets.region(F.col("s"))).collect()) == states


def test_volume_needs_all_sizes(spark):
    df = spark.createDataFrame(
        [(Decimal("2.50"), Decimal("2.00"), Decimal("3.00")), (None, Decimal("2.00"), Decimal("3.00"))],
        "length_cm decimal(10,2), height_cm decimal(10,2), width_cm decimal(10,2)",
    )
    got = [r[0] for r in df.select(dimensions.volume()).collect()]
    assert got == [Decimal("15.000000"), None]


def test_largest_sizes_do_not_overflow(spark):
    most = Decimal("99999999.99")
    df = spark.createDataFrame([(most,) * 3], "length_cm decimal(10,2), height_cm decimal(10,2), width_cm decimal(10,2)")
    assert df.select(dimensions.volume()).first()[0] == Decimal("999999999700000000029999.999999")


def test_customers_collapse_to_persons(spark):
    customers = spark.createDataFrame(
        [("1", "u", "01000", "b", "SP"), ("2", "u", "02000", "a", "RJ"), ("3", "v", None, None, None)],
        "customer_id string, customer_unique_id string, zip_code_prefix string, city string, state string",
    )
    got = {r.customer_unique_id: r for r in dimensions.dim_customers(customers).collect()}
    assert (got["u"].zip_code_prefix, got["u"].city, got["u"].state) == ("02000", "b", "SP")
    assert (got["u"].order_account_count, got["v"].order_account_count) == (2, 1)
    assert got["u"].customer_key == hashlib.md5(b"u").hexdigest()


def test_key_parts_keep_their_place(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), (None, None)], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 4
    single = [r[0] for r in df.select(surrogate_key("x")).distinct().collect()]
    assert hashlib.md5(b"a").hexdigest() in single and len(single) == 2


def test_key_of_text_and_number(spark):
    df = spark.createDataFrame([("o", 7)], "o string, n bigint")
    assert df.select(surrogate_key("o", "n")).first()[0] == hashlib.md5(b"o-7").hexdigest()


def test_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2), (3, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None, None]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=50))
def test_rounding_is_close_and_symmetric(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    both = df.select("v", round_half_away(F.col("v"), 2), round_half_away(-F.col("v"), 2))
    for value, rounded, mirrored in both.collect():
        assert abs(rounded - value) <= 0.005 + 1e-6
        assert rounded == -mirrored


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (None,)], "v double")
    assert [r[0] for r in df.select(round_half_away(F.col("v"), 2)).collect()] == [0.13, -0.13, 2.5, None]
