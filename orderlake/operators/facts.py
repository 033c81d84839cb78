"""Facts at order, order-item and payment grain."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.buckets import installment_bucket
from orderlake.functions.keys import surrogate_key
from orderlake.functions.numbers import MONEY_TOTAL
from orderlake.operators.staging import line_total, with_flags

ORDER_COLUMNS = (
    "order_key",
    "order_id",
    "order_date_key",
    "order_status",
    "is_delivered",
    "is_canceled",
    "is_in_progress",
    "is_late_delivery",
    "purchased_at",
    "approved_at",
    "shipped_at",
    "delivered_at",
    "estimated_delivery_at",
    "delivery_days_actual",
    "delivery_days_estimated",
    "delivery_days_vs_estimate",
)
CUSTOMER_COLUMNS = ("customer_key", "customer_unique_id")
ITEM_COUNTS = ("item_count", "distinct_product_count", "distinct_seller_count")
ITEM_COLUMNS = (*ITEM_COUNTS, "gross_item_revenue", "total_freight", "gross_revenue", "avg_item_price")
PAYMENT_COLUMNS = (
    "total_payment_amount",
    "max_installments",
    "primary_payment_type",
    "is_multi_payment_method",
)


def fct_orders(
    orders: DataFrame,
    customers: DataFrame | None = None,
    items: DataFrame | None = None,
    payments: DataFrame | None = None,
) -> DataFrame:
    """One row per order. `items` and `payments` are the roll-ups, whole or without some columns; `orders` without
    flags get them after the joins.

    A part that is not given adds neither its join nor its columns. Orders meet the customers first,
    while their rows are narrow; both roll-ups are then joined on order_id, which they are already
    partitioned by. Keys are hashed last, so no digest goes through a shuffle. The customer key comes
    from the person id, so dim_customers is not joined; it is null where no customer was found.
    """
    facts, columns = orders, list(ORDER_COLUMNS)
    derived = {
        "order_key": surrogate_key("order_id"),
        "order_date_key": F.col("purchased_at").cast("date"),
        "delivery_days_vs_estimate": F.col("delivery_days_actual") - F.col("delivery_days_estimated"),
    }
    if customers is not None:
        facts = facts.join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
        person = F.col("customer_unique_id")
        derived["customer_key"] = F.when(person.isNotNull(), surrogate_key(person))
        columns += CUSTOMER_COLUMNS
    if items is not None:
        known = [c for c in ITEM_COLUMNS if c in items.columns]
        facts = facts.join(items.select("order_id", *known), "order_id", "left")
        # An order without items counts zero of them, but its sums and mean stay unknown.
        derived |= {c: F.coalesce(F.col(c), F.lit(0)) for c in ITEM_COUNTS if c in known}
        columns += known
    if payments is not None:
        facts = facts.join(payments.select("order_id", *PAYMENT_COLUMNS), "order_id", "left")
        columns += PAYMENT_COLUMNS
    if "is_delivered" not in orders.columns:
        facts = with_flags(facts)
    return facts.select(*(derived[c].alias(c) if c in derived else F.col(c) for c in columns))


def counted_once(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """The roll-up of payments, taken from fct_payments, which holds a payment once for each row of its order.

    All but the total is the same for payments that come several times; the total is divided by their number.
    """
    rows, total = F.col("rows of the order"), F.col("total_payment_amount")
    counted = payments.join(orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("rows of the order")), "order_id")
    once = F.when(rows == 1, total).otherwise((total / rows).cast(MONEY_TOTAL))
    return counted.withColumn("total_payment_amount", once).drop("rows of the order")


# Keys of a line that come from the line alone: key -> the columns that it is made of.
ITEM_KEYS = {"order_item_key": ("order_id", "item_sequence"), "product_key": ("product_id",), "seller_key": ("seller_id",)}
PAYMENT_KEYS = {"payment_key": ("order_id", "installment_sequence")}


def key_columns(keys: Mapping[str, tuple[str, ...]]) -> list[Column]:
    return [surrogate_key(*parts).alias(key) for key, parts in keys.items()]


def fct_order_items(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line; lines without an order or customer are left out.

    Orders and customers are joined first, so that the long item table is shuffled once only.
    """
    context = orders.select(
        "order_id",
        "customer_id",
        F.col("purchased_at").cast("date").alias("order_date_key"),
        F.col("delivered_at").cast("date").alias("delivery_date_key"),
        "order_status",
        "is_delivered",
        "is_late_delivery",
    ).join(customers.select("customer_id", "customer_unique_id"), "customer_id")
    # The total is computed where the line has arrived, and a day is shorter than a moment.
    lines = items.drop("total_item_revenue").withColumn("shipping_limit_date_key", F.col("shipping_limit_at").cast("date"))
    order_item_key, *keys_of_parents = key_columns(ITEM_KEYS)
    return lines.join(context, "order_id").select(
        "order_id",
        "item_sequence",
        order_item_key,
        surrogate_key("customer_unique_id").alias("customer_key"),
        *keys_of_parents,
        "product_id",
        "seller_id",
        "customer_unique_id",
        "order_date_key",
        "delivery_date_key",
        "shipping_limit_date_key",
        "order_status",
        "is_delivered",
        "is_late_delivery",
        "item_price",
        "freight_value",
        line_total(F.col("item_price"), F.col("freight_value")).alias("total_item_revenue"),
    )


def fct_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment record, dated by its order's purchase."""
    context = orders.select("order_id", F.col("purchased_at").cast("date").alias("order_date_key"), "order_status")
    return payments.join(context, "order_id").select(
        "order_id",
        "installment_sequence",
        *key_columns(PAYMENT_KEYS),
        "order_date_key",
        "order_status",
        "payment_type",
        "installment_count",
        "payment_amount",
        installment_bucket(F.col("installment_count")).alias("installment_bucket"),
    )
