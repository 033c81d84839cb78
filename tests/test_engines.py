"""All models on random raw tables with nulls, orphans, repeats and ties, against DuckDB."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest

from orderlake.operators.checks import CHECKS, ORDER_STATUSES, PAYMENT_TYPES, check_report
from orderlake.operators.dimensions import years_covering
from orderlake.operators.metrics import METRICS, metric_query
from orderlake.plans import oracle
from orderlake.plans.star import Star
from tests.compare import assert_same
from tests.shop import ROWS, shop

MODELS = {
    "item_rollup": "int_order_items_rolled_up",
    "payment_rollup": "int_payments_rolled_up",
} | {name: name for name in oracle.TABLES if name.startswith(("stg_", "dim_", "fct_", "time_"))}


def random_shop(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)

    def maybe(value, share=0.15):
        return None if rng.random() < share else value

    def moment():
        return maybe(dt.datetime(2017, 12, 20) + dt.timedelta(minutes=rng.randrange(60 * 24 * 90)))

    def amount(top):
        return maybe(Decimal(rng.randrange(-200, top)) / 100)

    def id_of(kind, count):
        return maybe(f"{kind}{rng.randrange(count)}", 0.05)

    orders = [f"o{n}" for n in range(60)]
    return {
        "orders": [
            (o, id_of("c", 25), maybe(rng.choice([*ORDER_STATUSES, "returned"])), moment(), moment(), moment(), moment(), moment())
            for o in orders
        ],
        "order_items": [
            (id_of("o", 66), n, id_of("p", 12), id_of("s", 6), moment(), amount(20000), amount(900)) for n in range(150)
        ],
        # Few different amounts make ties; the sequence settles them.
        "order_payments": [
            (id_of("o", 66), n, maybe(rng.choice(PAYMENT_TYPES)), maybe(rng.randrange(-1, 15)), maybe(Decimal(rng.randrange(3))))
            for n in range(150)
        ],
        "customers": [
            (f"c{n}", maybe(f"u{n % 9}"), maybe(f"0{n}"), maybe(rng.choice("xyz")), maybe(rng.choice(["SP", "AM", "??"])))
            for n in range(22)
        ],
        "products": [
            (f"p{n}", maybe(rng.choice(["a", "b", "c"])), maybe(n), maybe(n), maybe(n), amount(2000000), amount(900),
             amount(900), amount(900))
            for n in range(11)
        ],
        "sellers": [(f"s{n}", maybe("01"), maybe("x"), maybe(rng.choice(["SP", "RS", "DF", "PI", "TO", "XX"]))) for n in range(6)],
        "order_reviews": [(f"r{n}", id_of("o", 66), maybe(rng.randrange(7))) for n in range(20)],
        "product_category_name_translation": [("a", "alpha"), ("b", None)],
        "geolocation": ROWS["geolocation"],
    }


@pytest.fixture(scope="module", params=[1, 2, 3])
def engines(spark, request):
    raw = shop(spark, **random_shop(request.param))
    con = duckdb.connect()
    for name, view in oracle.RAW_NAMES.items():
        con.register(view, raw[name].toArrow())
    return Star(raw, years_covering(raw["orders"], "order_purchase_timestamp")), con


def without_adapters(sql: str) -> str:
    """A statement on raw tables that exist, in place of those that the adapters define."""
    for name, (_, text) in oracle.TABLES.items():
        if name.startswith("raw_"):
            sql = sql.replace(f"{name} as ({text}),\n", "")
    return sql


@pytest.mark.parametrize("name", MODELS)
def test_models(engines, name):
    star, con = engines
    assert_same(star[MODELS[name]], con, without_adapters(oracle.table(name)))


@pytest.mark.parametrize(
    "group_by",
    [
        [],
        ["metric_time__month"],
        ["orders__payment_type"],
        ["order__is_multi_payment_method", "order__order_status"],
        ["customer__customer_state", "metric_time__quarter"],
        ["customer"],
    ],
    ids=str,
)
def test_metrics(engines, group_by):
    star, con = engines
    names = [m for m in METRICS if m != "cumulative_revenue"]
    assert_same(metric_query(star, names, group_by), con, without_adapters(oracle.metric(names, group_by)))


@pytest.mark.parametrize(
    "query, group_by, metrics",
    [
        (oracle.CUMULATIVE_BY_DAY, ["metric_time"], ["cumulative_revenue"]),
        (oracle.CUMULATIVE_BY_MONTH, ["metric_time__month"], ["cumulative_revenue", "revenue"]),
    ],
    ids=["day", "month"],
)
def test_running_totals(engines, query, group_by, metrics):
    star, con = engines
    assert_same(metric_query(star, metrics, group_by, every_period=True), con, without_adapters(query))


def test_checks(spark, engines):
    star, con = engines
    report = check_report(spark, star)
    assert_same(report, con, without_adapters(oracle.report()))
    assert report.filter("violations > 0").count() > len(CHECKS) // 4
