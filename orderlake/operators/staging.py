"""Staging: one row in, one row out. Names are settled, types fixed, simple flags derived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.calendar import days_between
from orderlake.functions.numbers import money

# Order states that are neither finished nor given up.
IN_PROGRESS = ("processing", "approved", "invoiced", "shipped", "created")

# Fixed value: category of a product that has none.
NO_CATEGORY = "unknown"


# Staging columns that are raw columns under the same or another name, of models with one row for each
# raw row: staging model -> (raw table, staging column -> raw column). A product's row may repeat with
# its category's translation, so products are not among them.
UNCHANGED = {
    "stg_orders": ("orders", {c: c for c in ("order_id", "customer_id", "order_status")}),
    "stg_order_items": ("order_items", {"order_id": "order_id", "item_sequence": "order_item_id"}),
    "stg_customers": ("customers", {c: c for c in ("customer_id", "customer_unique_id")}),
    "stg_sellers": ("sellers", {"seller_id": "seller_id"}),
    "stg_payments": ("order_payments", {"order_id": "order_id"}),
}


def moment(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def holds(condition: Column) -> Column:
    """A condition as a plain flag: false where it cannot be told."""
    return F.coalesce(condition, F.lit(False))


def stg_customers(customers: DataFrame) -> DataFrame:
    """customer_id is made per order; customer_unique_id is the person."""
    return customers.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Orders with status flags, delivery times in calendar days, and a late flag."""
    return with_flags(stg_order_moments(orders))


def stg_order_moments(orders: DataFrame) -> DataFrame:
    """Staged orders without what is derived from them, for runs that move them and derive it where they arrive."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        moment("order_purchase_timestamp").alias("purchased_at"),
        moment("order_approved_at").alias("approved_at"),
        moment("order_delivered_carrier_date").alias("shipped_at"),
        moment("order_delivered_customer_date").alias("delivered_at"),
        moment("order_estimated_delivery_date").alias("estimated_delivery_at"),
    )


def with_flags(orders: DataFrame) -> DataFrame:
    """The late flag is null until delivery; a delivered order without an estimate is not late."""
    status, purchased = F.col("order_status"), F.col("purchased_at")
    delivered, estimate = F.col("delivered_at"), F.col("estimated_delivery_at")
    return orders.select(
        "*",
        holds(status == "delivered").alias("is_delivered"),
        holds(status == "canceled").alias("is_canceled"),
        holds(status.isin(*IN_PROGRESS)).alias("is_in_progress"),
        days_between(purchased, delivered).alias("delivery_days_actual"),
        days_between(purchased, estimate).alias("delivery_days_estimated"),
        F.when(delivered.isNotNull(), holds(delivered > estimate)).alias("is_late_delivery"),
    )


def item_amounts() -> list[Column]:
    price, freight = money(F.col("price")), money(F.col("freight_value"))
    return [
        price.alias("item_price"),
        freight.alias("freight_value"),
        line_total(price, freight).alias("total_item_revenue"),
    ]


def line_total(price: Column, freight: Column) -> Column:
    """What a line comes to, from its staged amounts; computed again where rows moved, it need not move with them."""
    return price + freight


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id",
        F.col("order_item_id").alias("item_sequence"),
        "product_id",
        "seller_id",
        moment("shipping_limit_date").alias("shipping_limit_at"),
        *item_amounts(),
    )


def stg_item_amounts(order_items: DataFrame) -> DataFrame:
    """What roll-ups need of the items: all but their sequence and dates."""
    return order_items.select("order_id", "product_id", "seller_id", *item_amounts())


def stg_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select(
        "order_id",
        F.col("payment_sequential").alias("installment_sequence"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("installment_count"),
        money(F.col("payment_value")).alias("payment_amount"),
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name; else the original one; else a fixed word.

    Spark sees the size of the translation table and broadcasts it while it is small.
    """
    original, english = F.col("product_category_name"), F.col("product_category_name_english")
    names = translation.select("product_category_name", "product_category_name_english")
    return products.join(names, "product_category_name", "left").select(
        "product_id",
        F.coalesce(english, original, F.lit(NO_CATEGORY)).alias("category_name"),
        original.alias("category_name_pt"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_photos_qty").alias("photos_qty"),
        *(F.col(f"product_{size}").cast("decimal(10,2)").alias(size) for size in SIZES),
    )


SIZES = ("weight_g", "length_cm", "height_cm", "width_cm")


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )
