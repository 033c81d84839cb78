"""Checks must find what is planted, and nothing else."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from orderlake.operators import checks
from orderlake.operators.checks import CHECKS, Check, check_report, run_check, status_counts
from orderlake.operators.dimensions import date_range
from orderlake.plans.star import Star
from tests.shop import ROWS, at, shop


def found(spark, **changed):
    """Checks with violations on a shop with other rows in some tables."""
    star = Star(shop(spark, **changed), date_range(spark, "2018-01-01", "2019-01-01"))
    report = check_report(spark, star).collect()
    assert len(report) == 84
    return {r.check: (r.violations, r.status) for r in report if r.status != "pass"}


CLEAN = {
    "orders": [r for r in ROWS["orders"] if r[0] != "stranger"],
    "order_items": [r for r in ROWS["order_items"] if r[0] not in ("stranger", "nowhere")],
    "order_payments": [r for r in ROWS["order_payments"] if r[0] not in ("stranger", "nowhere")],
}


def test_registry():
    kinds = [c.kind for c in CHECKS]
    assert len({c.name for c in CHECKS}) == len(CHECKS) == 84
    assert kinds.count("relationships") == 11
    per_table = {t: sum(c.table == t for c in CHECKS) for t in {c.table for c in CHECKS}}
    assert per_table == {
        "orders": 6, "order_items": 7, "customers": 3, "products": 2, "sellers": 2, "order_payments": 3,
        "order_reviews": 3, "product_category_name_translation": 3, "stg_orders": 4, "stg_order_items": 2,
        "stg_customers": 3, "stg_products": 3, "stg_sellers": 2, "stg_payments": 1, "dim_dates": 4,
        "dim_customers": 5, "dim_products": 6, "dim_sellers": 5, "fct_orders": 9, "fct_order_items": 5,
        "fct_payments": 4, "time_spine": 2,
    }
    assert [c.name for c in CHECKS if c.severity == "warn"] == ["assert_order_revenue_matches_payments"]


def test_clean_shop(spark):
    assert found(spark, **CLEAN) == {}


def test_orphans(spark):
    assert found(spark) == {
        "relationships:orders.customer_id": (1, "error"),
        "relationships:order_items.order_id": (1, "error"),
        "relationships:order_payments.order_id": (1, "error"),
    }


def test_planted_rows(spark):
    orders = CLEAN["orders"]
    bad = [(None, "c1", "lost", at("2020-01-01"), None, None, None, None)] * 2
    reviews = [*ROWS["order_reviews"], ("r3", "late", 6), ("r4", "late", 6), ("r5", "late", 0)]
    got = found(spark, **{**CLEAN, "orders": [*orders, orders[0], *bad], "order_reviews": reviews})
    assert got["unique:orders.order_id"] == (1, "error")
    assert got["unique:fct_orders.order_id"] == (1, "error")
    assert got["not_null:orders.order_id"] == got["not_null:stg_orders.order_id"] == (2, "error")
    assert got["accepted_values:orders.order_status"] == (1, "error")
    assert got["accepted_values:order_reviews.review_score"] == (2, "error")
    assert got["relationships:fct_orders.order_date_key"] == (2, "error")
    # A null order id still has a key of its own, which two such orders share.
    assert got["unique:fct_orders.order_key"] == (2, "error")
    assert got["unique:fct_order_items.order_item_key"] == (2, "error")


def test_revenue_rules(spark):
    items = [*CLEAN["order_items"], ("paid", 2, "p1", "s2", None, Decimal("-50.00"), Decimal("0.00"))]
    assert found(spark, **{**CLEAN, "order_items": items}) == {
        "assert_no_negative_revenue": (1, "error"),
        "assert_order_revenue_matches_payments": (1, "warn"),
    }


def test_report_agrees_with_the_single_checks(spark):
    raw = shop(spark, customers=[*ROWS["customers"], ("c1", None, "1", "x", None)])
    star = Star(raw, date_range(spark, "2018-02-01", "2018-03-01"))
    report = {r.check: r.violations for r in check_report(spark, star).collect()}
    for check in CHECKS:
        rows = run_check(check, star).collect()
        grouped = check.kind == "relationships"
        assert report[check.name] == (sum(r.row_count for r in rows) if grouped else len(rows)), check


@pytest.mark.parametrize("child, parent", [("bigint", "decimal(10,2)"), ("int", "double"), ("date", "timestamp_ntz"), ("double", "float")])
def test_report_agrees_with_the_single_checks_on_mixed_types(spark, child, parent):
    days = "date'2020-01-0{}'" if child == "date" else "{}"
    values = lambda kind, *numbers: spark.sql(
        " union all ".join(f"select cast({days.format(n) if n else 'null'} as {kind}) v" for n in numbers)
    )
    tables = {"child": values(child, 1, 1, 2, 3, None), "parent": values(parent, 1, 2, 2, None)}
    rules = [
        Check("child", "relationships", "v", parent="parent", field="v"),
        Check("child", "unique", "v"),
        Check("parent", "unique", "v"),
        Check("child", "not_null", "v"),
    ]
    report = [r.violations for r in check_report(spark, tables, rules).sort("table_name", "kind").collect()]
    assert report == [1, 1, 1, 1]
    assert sum(r.row_count for r in run_check(rules[0], tables).collect()) == 1


def test_status_counts(spark):
    tables = {"t": spark.createDataFrame([(1,), (1,), (None,)], "a int")}
    rules = [Check("t", "unique", "a"), Check("t", "not_null", "a", severity="warn"), Check("t", "accepted_values", "a", (1,))]
    report = check_report(spark, tables, rules)
    assert {r.status: r.checks for r in status_counts(report).collect()} == {"error": 1, "warn": 1, "pass": 1}


def test_single_operators(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None)], "n int, t string")
    assert [tuple(r) for r in checks.unique(df, "n", "t").collect()] == [(1, "a", 2)]
    assert [tuple(r) for r in checks.unique(df, "n").collect()] == [(1, 3)]
    assert checks.not_null(df, "n").count() == 2
    assert sorted(tuple(r) for r in checks.accepted_values(df, "t", ["b"]).collect()) == [("a", 4)]
    assert [tuple(r) for r in checks.accepted_values(df, "n", [1]).collect()] == [(2, 1)]
    parent = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert [tuple(r) for r in checks.relationships(df, "n", parent, "k").collect()] == [(2, 1)]


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        run_check(Check("t", "guess", "a"), {"t": spark.range(1)})


@pytest.mark.parametrize("kind", ["bigint", "int", "date", "string"])
def test_relationships_with_values_near_and_far(spark, kind):
    """Dense values, values beyond the filter of the parent's, negative and extreme ones, and an empty parent."""
    far = [2**40, -(2**62), 2**62] if kind == "bigint" else [3_000_000 if kind != "date" else 2_000_000]
    parents, children = [-5, 0, 1, 2, 900, *far[:1]], [-6, -5, 0, 0, 3, 3, 900, 1_048_575, *far, None]
    made = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} bigint").selectExpr(
        f"date_from_unix_date(cast({name} as int)) {name}" if kind == "date" else f"cast({name} as {kind}) {name}"
    )
    as_kind = lambda v: made([v], "v").first().v
    child, parent = made(children, "n"), made(parents, "k")
    want = sorted((as_kind(v), children.count(v)) for v in {*children} - {*parents, None})
    assert sorted(tuple(r) for r in checks.relationships(child, "n", parent, "k").collect()) == want
    assert sum(r.row_count for r in checks.relationships(child, "n", parent.limit(0), "k").collect()) == len(children) - 1


def test_matched_children_are_not_shuffled(spark):
    """Days that the calendar has drop out where they are read: one row leaves the scan, the violation."""
    child = spark.range(0, 100_000, 1, 8).selectExpr("date_add(date'2018-01-01', cast(id % 365 as int)) d")
    parent = spark.range(364).selectExpr("date_add(date'2018-01-01', cast(id as int)) k")
    found = checks.relationships(child, "d", parent, "k")
    assert [tuple(r) for r in found.collect()] == [(dt.date(2018, 12, 31), 273)]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "bit_get" in text


def test_repeated_keys_are_found_among_many(spark):
    """More keys than the filter has bits would fill it; repeated ones are all found, others are not."""
    rows = spark.range(0, 3_000_000, 1, 8).selectExpr("cast(if(id < 5, id + 5, id) as string) k")
    assert sorted(tuple(r) for r in checks.unique(rows, "k").collect()) == [(str(i), 2) for i in range(5, 10)]
    every = spark.range(0, 3_000_000, 1, 8).selectExpr("id div 2 k")
    assert checks.unique(every, "k").count() == 1_500_000
