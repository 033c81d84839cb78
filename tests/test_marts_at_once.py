"""The marts as one run writes them: the same rows as the lazy models, with less moved and written."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.operators.dimensions import date_range
from orderlake.operators.rollups import int_order_items_rolled_up
from orderlake.plans.build import LOADED_AT, build, refresh
from orderlake.plans.star import MARTS, Star
from orderlake.sources.published import published
from tests.shop import ROWS, at, shop

ITEMS, PAYMENTS = ROWS["order_items"], ROWS["order_payments"]
ODD = {
    "orders": [*ROWS["orders"], ROWS["orders"][0], *[(None, "c1", None, at("2018-03-01"), None, None, None, None)] * 2],
    "customers": [*ROWS["customers"], ("c1", None, "1", "x", None), (None, "eve", "2", "y", "SP")],
    "order_items": [*ITEMS, *ITEMS[:2], (None, 1, "p1", "s1", None, Decimal("5.00"), None), ("paid", 2, None, None, None, None, None)],
    "order_payments": [*PAYMENTS, *PAYMENTS[:2], (None, 1, "voucher", 1, Decimal("5.00")), ("empty", 1, None, None, None)],
}


def star_of(spark, rows) -> Star:
    return Star(shop(spark, **rows), date_range(spark, "2018-01-01", "2019-01-01"))


def same(left, right) -> bool:
    return left.dtypes == right.dtypes and left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("by_month", [False, True])
@pytest.mark.parametrize("place", ["{}", "database:marts_at_once"])
@pytest.mark.parametrize("rows", [{}, ODD], ids=["as given", "repeated and null keys"])
def test_written_marts_are_the_lazy_ones(spark, tmp_path, rows, place, by_month):
    star = star_of(spark, rows)
    try:
        stored = refresh(published(spark, place.format(tmp_path)), lambda save: build(star, save), by_month)
        for name in MARTS:
            assert same(stored.read(name).drop(LOADED_AT, "order_month"), star[name]), name
    finally:
        spark.sql("drop database if exists marts_at_once cascade")


def test_roll_up_from_one_shuffle(spark):
    items = spark.range(0, 5000, 1, 4).selectExpr(
        "if(id % 11 = 0, null, cast(id % 97 as string)) order_id",
        "if(id % 13 = 0, null, cast(id % 7 as string)) product_id",
        "if(id % 17 = 0, null, cast(id % 3 as string)) seller_id",
        "if(id % 5 = 0, null, cast(id % 900 as decimal(10,2))) item_price",
        "cast(id % 40 as decimal(10,2)) freight_value",
    ).withColumn("total_item_revenue", F.col("item_price") + F.col("freight_value"))
    once = int_order_items_rolled_up(items, one_shuffle=True)
    assert same(once, int_order_items_rolled_up(items))
    text = once._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_orders_move_each_item_once_and_read_written_payments(spark, tmp_path):
    star = star_of(spark, {})
    place = published(spark, str(tmp_path))
    written = refresh(place, lambda save: build(star, save, ["fct_payments"])).read("fct_payments")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = star.orders_beside(written)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    # Customers and orders by customer; then orders, items, payments and the numbers of orders' rows, each once by order.
    assert sorted(moved) == ["customer_id", "customer_id", "order_id", "order_id", "order_id", "order_id"]


def test_keys_are_stored_in_about_half_their_length(spark, tmp_path):
    keys = spark.range(0, 100_000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("key"))
    release = published(spark, str(tmp_path)).release()
    release.save(keys, "keys")
    (file,) = (tmp_path / "releases" / release.name / "keys").glob("*.parquet")
    assert file.stat().st_size < 100_000 * 22
    assert release.read("keys").count() == 100_000


def test_report_leaves_out_what_no_check_asks_for(spark):
    """Distinct products and sellers of an order are of no check, so that items are not grouped by order for them."""
    from orderlake.plans.queries import QUERIES

    text = QUERIES["check_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "struct<l_orderkey:bigint>" not in text
    assert "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text


def test_report_sorts_payments_once_they_are_together(spark):
    star = star_of(spark, ODD)
    text = star.order_facts(["total_payment_amount", "primary_payment_type"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text
