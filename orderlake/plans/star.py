"""The star schema: which operator is fed by which tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.buckets import installment_bucket
from orderlake.functions.keys import surrogate_key
from orderlake.operators import dimensions, facts, rollups, staging
from orderlake.operators.checks import Joined

STAGING = ("stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_sellers", "stg_payments")
ROLLUPS = ("int_order_items_rolled_up", "int_payments_rolled_up")
MARTS = (
    "dim_dates",
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "fct_orders",
    "fct_order_items",
    "fct_payments",
    "time_spine",
)

MODELS = {
    "stg_orders": (staging.stg_orders, "orders"),
    "stg_order_moments": (staging.stg_order_moments, "orders"),
    "stg_order_items": (staging.stg_order_items, "order_items"),
    "stg_item_amounts": (staging.stg_item_amounts, "order_items"),
    "stg_customers": (staging.stg_customers, "customers"),
    "stg_products": (staging.stg_products, "products", "product_category_name_translation"),
    "stg_sellers": (staging.stg_sellers, "sellers"),
    "stg_payments": (staging.stg_payments, "order_payments"),
    "order_item_totals": (rollups.order_item_totals, "stg_item_amounts"),
    "int_order_items_rolled_up": (rollups.int_order_items_rolled_up, "stg_item_amounts"),
    "int_payments_rolled_up": (rollups.int_payments_rolled_up, "stg_payments"),
    "dim_customers": (dimensions.dim_customers, "stg_customers"),
    "dim_products": (dimensions.dim_products, "stg_products"),
    "dim_sellers": (dimensions.dim_sellers, "stg_sellers"),
    "time_spine": (dimensions.time_spine, "dim_dates"),
    "fct_orders": (
        facts.fct_orders,
        "stg_orders",
        "stg_customers",
        "int_order_items_rolled_up",
        "int_payments_rolled_up",
    ),
    "fct_order_items": (facts.fct_order_items, "stg_order_items", "stg_orders", "stg_customers"),
    "fct_payments": (facts.fct_payments, "stg_payments", "stg_orders"),
}

DISTINCT_COUNTS = {"distinct_product_count", "distinct_seller_count"}


class Star:
    """Every model over one set of raw tables, as lazy DataFrames: `star["fct_orders"]`.

    `bounds` is the one-row calendar range. Staging and roll-ups are inlined into what uses them.
    """

    def __init__(self, raw: Mapping[str, DataFrame], bounds: DataFrame):
        self.raw = raw
        self.bounds = bounds
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name == "dim_dates" and name not in self._made:
            self._made[name] = dimensions.dim_dates(self.bounds)
        if name in MODELS and name not in self._made:
            operator, *inputs = MODELS[name]
            self._made[name] = operator(*(self[i] for i in inputs))
        if name in self._made:
            return self._made[name]
        return self.raw[name]

    def orders_beside(self, written_payments: DataFrame) -> DataFrame:
        """fct_orders for a run that has written fct_payments: every payment of an order is there, beside the order's others.

        So their sums leave a task as one row for an order, where those of raw payments, which lie anywhere, are wider than
        the payments and are sorted twice. Items are not taken from their fact, which leaves out those without a customer;
        they are brought together once, as they are.
        """
        items = rollups.int_order_items_rolled_up(self["stg_item_amounts"], one_shuffle=True)
        payments = facts.counted_once(rollups.int_payments_rolled_up(written_payments), self["stg_order_moments"])
        return facts.fct_orders(self["stg_order_moments"], self["stg_customers"], items, payments)

    def joined(self, name: str) -> Joined | None:
        """The steps of a fact that joins lines with their orders; None for another table."""
        orders, customers = self["stg_orders"], self["stg_customers"]
        if name == "fct_order_items":
            lines = self["stg_order_items"].select("*", *facts.key_columns(facts.ITEM_KEYS))
            people = customers.select("customer_id", "customer_unique_id", surrogate_key("customer_unique_id").alias("customer_key"))
            steps = [("", lines), ("order_id", orders), ("customer_id", people)]
            return Joined(steps, lambda some: facts.fct_order_items(some, orders, customers))
        if name == "fct_payments":
            bucket = installment_bucket(F.col("installment_count")).alias("installment_bucket")
            lines = self["stg_payments"].select("*", *facts.key_columns(facts.PAYMENT_KEYS), bucket)
            return Joined([("", lines), ("order_id", orders)], lambda some: facts.fct_payments(some, orders))
        return None

    def order_facts(self, columns: Iterable[str], since: str | None = None, until: str | None = None) -> DataFrame:
        """Some columns of fct_orders, with no join that they do not need. All days: lazy facts lie in no parts.

        The joins left out match at most one row per order, so leaving them out drops or repeats
        nothing: customer_id is the key of customers, order_id that of the roll-ups.
        """
        wanted = list(dict.fromkeys(columns))
        parts = {}
        if {*facts.CUSTOMER_COLUMNS} & {*wanted}:
            parts["customers"] = self["stg_customers"]
        if {*facts.ITEM_COLUMNS} & {*wanted}:
            counted = DISTINCT_COUNTS & {*wanted}
            parts["items"] = self["int_order_items_rolled_up" if counted else "order_item_totals"]
        if {*facts.PAYMENT_COLUMNS} & {*wanted}:
            # Raw payments of an order lie anywhere. Sums with texts are made by sorting; brought together by order before,
            # in pieces that adaptive execution cuts where one is too large, they are not sorted by the whole file piece.
            parts["payments"] = rollups.int_payments_rolled_up(self["stg_payments"].hint("rebalance", "order_id"))
        return facts.fct_orders(self["stg_orders"], **parts).select(*wanted)
