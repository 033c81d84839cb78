"""Numbers known for the sf0.01 tables (FIXTURES.md, section 5 and 6)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.operators.checks import check_report, status_counts
from orderlake.operators.metrics import metric_query
from orderlake.plans.queries import QUERIES, star_over

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def star(spark):
    return star_over(spark, FOLDER)


def counts(df, column):
    return {row[0]: row[1] for row in df.groupBy(column).count().collect()}


def test_grand_totals(star):
    row = metric_query(
        star,
        ["revenue", "item_revenue", "freight_cost", "payment_sum", "net_revenue", "order_count", "unique_customers",
         "avg_order_value", "avg_items_per_order", "revenue_per_customer", "cancellation_rate",
         "delivery_completion_rate", "freight_pct_of_revenue"],
    ).first()
    assert row.revenue == Decimal("33424454.57")
    assert row.item_revenue == row.net_revenue == Decimal("31832265.72")
    assert row.freight_cost == Decimal("1592188.85")
    assert row.payment_sum == Decimal("34553317.86")
    assert (row.order_count, row.unique_customers) == (15000, 750)
    assert row.avg_order_value == 2228.296971333333
    assert row.avg_items_per_order == 4.0
    assert row.revenue_per_customer == 44565.939426666664
    assert row.cancellation_rate == 0.08433333333333333
    assert row.delivery_completion_rate == 0.41246666666666665
    assert row.freight_pct_of_revenue == 0.04763544747351131


def test_orders(star):
    orders = star["stg_orders"]
    assert counts(orders, "order_status") == {
        "delivered": 6187, "shipped": 1250, "canceled": 1265, "invoiced": 1257,
        "processing": 1273, "unavailable": 1276, "created": 1250, "approved": 1242,
    }
    row = orders.agg(
        F.sum("delivery_days_actual"),
        F.sum("delivery_days_estimated"),
        F.count_if("is_late_delivery"),
        F.count_if(F.col("is_late_delivery").isNull()),
    ).first()
    assert tuple(row) == (140243, 366892, 2899, 8813)


def test_order_payments(star):
    facts = star["fct_orders"]
    assert counts(facts, "primary_payment_type") == {
        "credit_card": 8614, "boleto": 1521, "voucher": 1573, "debit_card": 1516, "not_defined": 1519, None: 257,
    }
    row = facts.agg(F.count_if("is_multi_payment_method"), F.sum("max_installments")).first()
    assert tuple(row) == (11796, 157327)


def test_buckets_and_regions(star):
    assert counts(star["dim_products"], "weight_bucket") == {
        "XS (<0.5kg)": 37, "S (0.5–2kg)": 131, "M (2–5kg)": 298, "L (5–15kg)": 1009, "XL (15kg+)": 504, "unknown": 21,
    }
    assert counts(star["dim_sellers"], "region") == {
        "Southeast": 12, "South": 14, "Center-West": 21, "Northeast": 41, "North": 10, "Unknown": 2,
    }
    assert counts(star["dim_products"], "category_name") == {
        "ECONOMY": 277, "large_goods": 310, "medium_goods": 317, "promo_goods": 290, "small_goods": 298,
        "standard_goods": 307, "unknown": 201,
    }


def test_time(star):
    years = metric_query(star, ["revenue"], ["metric_time__year"]).orderBy("metric_time__year").collect()
    assert [str(r.revenue) for r in years] == [
        "5095446.04", "5042489.98", "5030596.51", "5037872.52", "5079191.04", "5319071.55", "2819786.93",
    ]
    assert metric_query(star, ["revenue"], ["metric_time__month"]).count() == 80
    assert metric_query(star, ["revenue"], ["metric_time__day"]).count() == 2399
    running = metric_query(star, ["cumulative_revenue"], ["metric_time__day"], every_period=True)
    assert running.count() == 2405
    assert running.agg(F.max("cumulative_revenue")).first()[0] == Decimal("33424454.57")


def test_planted_violations(spark):
    assert QUERIES["check_unique"](spark, FOLDER).count() == 11785
    assert [tuple(r) for r in QUERIES["check_accepted_values"](spark, FOLDER).collect()] == [("unavailable", 1276)]
    assert QUERIES["check_not_null"](spark, FOLDER).count() == 21
    assert QUERIES["check_relationships_orders_without_items"](spark, FOLDER).count() == 257


def test_report(spark, star):
    report = check_report(spark, star).cache()
    assert report.count() == 84
    assert {r.status: r.checks for r in status_counts(report).collect()} == {"pass": 83, "warn": 1}
    warned = report.filter("status = 'warn'").first()
    assert (warned.check, warned.violations) == ("assert_order_revenue_matches_payments", 2126)


def test_reconciliation_by_type(spark):
    rows = QUERIES["assert_order_revenue_matches_payments"](spark, FOLDER)
    assert counts(rows, "primary_payment_type") == {
        "boleto": 959, "not_defined": 947, "credit_card": 164, "voucher": 30, "debit_card": 26,
    }
