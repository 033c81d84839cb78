"""Facts: which rows they keep, what stays null."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest

from orderlake.functions.keys import surrogate_key
from orderlake.operators.checks import (
    assert_no_negative_revenue,
    assert_order_revenue_matches_payments,
)
from orderlake.operators.dimensions import date_range, dim_customers
from orderlake.plans.star import Star
from tests.shop import shop


@pytest.fixture(scope="module")
def star(spark):
    return Star(shop(spark), date_range(spark, "2018-01-01", "2019-01-01"))


@pytest.fixture(scope="module")
def orders(star):
    return {r.order_id: r for r in star["fct_orders"].collect()}


def test_one_row_per_order(star, orders):
    assert star["fct_orders"].count() == len(orders) == 5


def test_order_without_items(orders):
    row = orders["empty"]
    assert (row.item_count, row.distinct_product_count, row.distinct_seller_count) == (0, 0, 0)
    assert row.gross_item_revenue is row.total_freight is row.gross_revenue is row.avg_item_price is None
    assert row.total_payment_amount is row.max_installments is row.primary_payment_type is None
    assert row.is_multi_payment_method is None


def test_order_without_customer(orders):
    row = orders["stranger"]
    assert row.customer_key is None and row.customer_unique_id is None
    assert row.gross_revenue == Decimal("11.00")


def test_customer_key_is_that_of_the_dimension(star, orders):
    keys = {r.customer_unique_id: r.customer_key for r in dim_customers(star["stg_customers"]).collect()}
    assert orders["late"].customer_key == keys["ann"]


def test_days_against_estimate(orders):
    assert (orders["late"].delivery_days_actual, orders["late"].delivery_days_estimated) == (9, 4)
    assert orders["late"].delivery_days_vs_estimate == 5
    assert orders["empty"].delivery_days_vs_estimate is None


def test_fewer_parts_give_the_same_columns(star):
    whole = star["fct_orders"]
    for columns in (
        ["order_id", "order_date_key"],
        ["order_id", "customer_key"],
        ["order_id", "item_count", "gross_revenue"],
        ["order_id", "distinct_seller_count", "avg_item_price"],
        ["order_id", "primary_payment_type", "total_payment_amount", "customer_unique_id"],
    ):
        few = star.order_facts(columns)
        assert few.columns == columns
        assert Counter(few.collect()) == Counter(whole.select(*columns).collect())


def test_item_fact_drops_orphans(star):
    rows = star["fct_order_items"].collect()
    assert sorted((r.order_id, r.item_sequence) for r in rows) == [("late", 1), ("late", 2), ("paid", 1)]
    assert all(r.product_key and r.seller_key and r.customer_key for r in rows)


def test_payment_fact_drops_orphans(star):
    rows = {(r.order_id, r.installment_sequence): r for r in star["fct_payments"].collect()}
    assert sorted(rows) == [("canceled", 1), ("late", 1), ("late", 2), ("paid", 1), ("stranger", 1)]
    assert rows["late", 1].installment_bucket == "4-6"
    assert rows["paid", 1].installment_bucket == "unknown"


def test_fact_keys(star):
    items = star["fct_order_items"]
    assert items.filter(items.order_item_key != surrogate_key("order_id", "item_sequence")).count() == 0


ORDERS = """order_id string, primary_payment_type string, max_installments int, gross_revenue decimal(38,2),
    total_payment_amount decimal(38,2), is_canceled boolean"""


@pytest.mark.parametrize(
    "payment_type, revenue, at_limit, beyond",
    [
        ("credit_card", "100.00", "200.00", "200.01"),
        ("credit_card", "1000.00", "1350.00", "1350.01"),
        ("credit_card", "1000.00", "650.00", "649.99"),
        ("debit_card", "100.00", "80.00", "79.99"),
        ("debit_card", "1000.00", "1050.00", "1050.01"),
        ("voucher", "100.00", "120.00", "120.01"),
        ("voucher", "1000.00", "900.00", "899.99"),
        ("boleto", "1000.00", "1005.00", "1005.01"),
        (None, "1000.00", "995.00", "994.99"),
        ("boleto", "0.00", "5.00", "5.01"),
    ],
)
def test_reconciliation_limits(spark, payment_type, revenue, at_limit, beyond):
    rows = [(n, payment_type, 1, Decimal(revenue), Decimal(p), c) for n, p, c in (
        ("at", at_limit, False), ("beyond", beyond, False), ("canceled", beyond, True),
    )]
    rows += [("unpaid", payment_type, 1, Decimal(revenue), None, False), ("no items", None, 1, None, Decimal(9), False)]
    found = assert_order_revenue_matches_payments(spark.createDataFrame(rows, ORDERS)).collect()
    assert [r.order_id for r in found] == ["beyond"]
    assert found[0].discrepancy == abs(Decimal(revenue) - Decimal(beyond))
    if revenue == "0.00":
        assert found[0].uplift_pct is None
    else:
        percent = float(100 * (Decimal(beyond) - Decimal(revenue)) / Decimal(revenue))
        assert abs(found[0].uplift_pct - percent) <= 0.005 + 1e-9


def test_negative_revenue(spark):
    rows = [("a", Decimal("-0.01")), ("b", Decimal("0.00")), ("c", None), ("d", Decimal("5.00"))]
    df = spark.createDataFrame(rows, "order_id string, gross_revenue decimal(38,2)")
    assert [r.order_id for r in assert_no_negative_revenue(df).collect()] == ["a"]
