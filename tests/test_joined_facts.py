"""The report over lazy facts: rows that break nothing are not moved, and it is still the report over the whole facts."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.operators import checks
from orderlake.operators.checks import CHECKS, Check, check_report, compact, in_full
from orderlake.operators.dimensions import date_range
from orderlake.plans.star import Star
from tests.shop import ROWS, at, shop

ITEMS, PAYMENTS, ORDERS = ROWS["order_items"], ROWS["order_payments"], ROWS["orders"]
ODD = {
    "orders and lines twice, nulls": {
        "orders": [*ORDERS, ORDERS[0], *[(None, "c1", None, at("2018-03-01"), None, None, None, None)] * 2],
        "order_items": [*ITEMS, *ITEMS[:2], (None, 1, "p1", "s1", None, Decimal("5.00"), None), ("paid", 2, None, None, None, None, None)],
        "order_payments": [*PAYMENTS, *PAYMENTS[:2], (None, 1, "voucher", 1, Decimal("5.00")), ("empty", 1, None, None, None)],
    },
    "customers twice, one without a person": {"customers": [*ROWS["customers"], ("c2", "bob", "1", "x", None), ("c3", None, "2", "y", "SP")]},
    "no parents": {"products": [ROWS["products"][1]], "sellers": []},
    "types outside the list": {"order_payments": [*PAYMENTS, ("paid", 2, "shells", 1, Decimal("1.00")), ("nowhere", 2, "shells", 1, None)]},
    "keys that come to the same": {
        "orders": [*ORDERS, ("a-b", "c1", "shipped", at("2018-03-01"), None, None, None, None), ("a", *ORDERS[1][1:])],
        "order_items": [*ITEMS, ("a-b", 1, "p1", "s1", None, None, None), ("a", 1, "p1", "s1", None, None, None)],
    },
    "nothing": {table: [] for table in ROWS},
}


def star_of(spark, rows) -> Star:
    return Star(shop(spark, **rows), date_range(spark, "2018-01-01", "2019-01-01"))


def violations(report) -> dict:
    return {r.check: (r.violations, r.status) for r in report.collect()}


@pytest.mark.parametrize("rows", ODD.values(), ids=ODD)
def test_report_is_that_of_the_whole_facts(spark, rows):
    star = star_of(spark, rows)
    whole = {name: star[name] for check in CHECKS for name in (check.table, check.parent) if name}
    more = [
        Check("fct_order_items", "accepted_values", "order_status", ("delivered",)),
        Check("fct_order_items", "not_null", "customer_unique_id"),
        Check("fct_payments", "relationships", "order_status", parent="orders", field="order_status"),
        Check("fct_payments", "not_null", "installment_count"),
    ]
    assert violations(check_report(spark, star, [*CHECKS, *more])) == violations(check_report(spark, whole, [*CHECKS, *more]))


def test_keys_of_other_tables_and_mixed_types_take_the_whole_join(spark):
    star = star_of(spark, ODD["customers twice, one without a person"])
    rules = [Check("fct_order_items", "unique", "customer_unique_id"), Check("fct_payments", "unique", "order_date_key")]
    whole = {name: star[name] for name in ("fct_order_items", "fct_payments")}
    assert violations(check_report(spark, star, rules)) == violations(check_report(spark, whole, rules))

    raw = shop(spark, orders=[("7", *ORDERS[0][1:])] * 2, order_payments=[("7", 1, "boleto", 1, None)])
    raw["order_payments"] = raw["order_payments"].withColumn("order_id", F.col("order_id").cast("int"))
    mixed = Star(raw, date_range(spark, "2018-01-01", "2019-01-01"))
    assert violations(check_report(spark, mixed, [Check("fct_payments", "unique", "payment_key")])) == {
        "unique:fct_payments.payment_key": (1, "error")
    }


@pytest.mark.parametrize("name, joined_before", [("fct_order_items", 4000), ("fct_payments", 4000)])
def test_lines_that_break_nothing_are_not_joined(spark, name, joined_before):
    """Of 4,000 lines the operator gets those that a rule is about, and few that a filter takes for them."""
    numbers = lambda n, *columns: spark.range(0, n, 1, 4).selectExpr(*columns)
    raw = shop(spark)
    raw["orders"] = numbers(1000, "cast(id as string) order_id", "cast(id % 90 as string) customer_id", "'shipped' order_status").select(
        "*", *(F.lit("2018-03-01").cast("timestamp_ntz").alias(c) for c in raw["orders"].columns[3:])
    )
    raw["customers"] = numbers(90, "cast(id as string) customer_id", "cast(id as string) customer_unique_id").select(
        "*", *(F.lit("1").alias(c) for c in raw["customers"].columns[2:])
    )
    line = ("cast(id div 4 as string) order_id", "if(id = 7, 1, id % 4) as number")
    raw["order_items"] = numbers(4000, *line, "if(id = 99, 'p3', 'p1') product_id", "'s1' seller_id").select(
        "order_id", F.col("number").cast("int").alias("order_item_id"), "product_id", "seller_id",
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        *(F.lit("1").cast("decimal(10,2)").alias(c) for c in ("price", "freight_value")),
    )
    raw["order_payments"] = numbers(4000, *line, "if(id = 99, 'shells', 'boleto') payment_type").select(
        "order_id", F.col("number").cast("int").alias("payment_sequential"), "payment_type",
        F.lit(1).alias("payment_installments"), F.lit("1").cast("decimal(10,2)").alias("payment_value"),
    )
    star = Star(raw, date_range(spark, "2018-01-01", "2019-01-01"))
    assert star[name].count() == joined_before
    got = {}
    fact = star.joined(name)
    spied = fact._replace(fact=lambda lines: got.update(lines=lines) or fact.fact(lines))
    rules = {n: c for n, c in enumerate(CHECKS) if c.table == name}
    rows = checks.suspects(rules, star, spied)
    assert {("1", 1), ("24", 3)} <= {(r[0], r[1]) for r in rows.collect()}
    assert 3 <= rows.count() == got["lines"].count() < 20


def test_digests_are_compared_in_half_their_length(spark):
    texts = ["", "a", "0" * 15, "0" * 16, "0" * 17, "0" * 31, "0" * 32, "0" * 33, "A" * 32, "g" * 32, "a" * 32, "\0" * 16, "é" * 16, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("value", compact(F.col("t")))
    rows = df.select("t", "value", in_full(F.col("value")).alias("back"), F.octet_length("value").alias("size")).collect()
    assert all(r.t == r.back for r in rows)
    assert len({r.value if r.value is None else bytes(r.value) for r in rows}) == len(texts)
    assert [r.t for r in rows if r.size == 16] == ["0" * 32, "a" * 32]
