"""Roll-ups of items and payments to one row per order.

Every aggregate here combines partial results before the shuffle, so an order that holds a large
share of all rows costs one partial row per task, not one long group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.numbers import MONEY_TOTAL, mean, money_sum
from orderlake.operators.staging import line_total


def order_item_totals(items: DataFrame) -> DataFrame:
    """The roll-up of items without its distinct counts: one pass, one shuffle."""
    price = F.col("item_price")
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        money_sum(price).alias("gross_item_revenue"),
        money_sum(F.col("freight_value")).alias("total_freight"),
        money_sum(F.col("total_item_revenue")).alias("gross_revenue"),
        mean(price).alias("avg_item_price"),
        F.max(price).alias("max_item_price"),
        F.min(price).alias("min_item_price"),
    )


def items_from_one_shuffle(items: DataFrame) -> DataFrame:
    """The roll-up of items from one shuffle of them, for runs that write what they roll up.

    Items come together by order once, as narrow rows; what follows needs no other place. They are summed by product and
    seller; the first of an order's rows with a seller counts that seller, and each product is left with one row. An order of
    very many items is the work of one task, which spills what does not fit; nothing is gathered into one value.
    """
    price = F.col("item_price")
    narrow = items.select("order_id", "product_id", "seller_id", "item_price", "freight_value")
    alike = narrow.repartition("order_id").groupBy("order_id", "product_id", "seller_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count(price).alias("prices"),
        F.sum(price).alias("price"),
        F.sum("freight_value").alias("freight"),
        F.sum(line_total(price, F.col("freight_value"))).alias("revenue"),
        F.max(price).alias("highest"),
        F.min(price).alias("lowest"),
    )
    first = F.row_number().over(Window.partitionBy("order_id", "seller_id").orderBy("product_id")) == 1
    summed = [F.sum(c).alias(c) for c in ("items", "prices", "price", "freight", "revenue")]
    highest, lowest = F.max("highest").alias("highest"), F.min("lowest").alias("lowest")
    products = (
        alike.withColumn("sellers", F.when(first & F.col("seller_id").isNotNull(), 1).otherwise(0))
        .groupBy("order_id", "product_id")
        .agg(F.sum("sellers").alias("sellers"), *summed, highest, lowest)
    )
    orders = products.groupBy("order_id").agg(
        F.count("product_id").alias("products"), F.sum("sellers").alias("sellers"), *summed, highest, lowest
    )
    return orders.select(
        "order_id",
        F.col("items").alias("item_count"),
        F.col("products").alias("distinct_product_count"),
        F.col("sellers").alias("distinct_seller_count"),
        F.col("price").cast(MONEY_TOTAL).alias("gross_item_revenue"),
        F.col("freight").cast(MONEY_TOTAL).alias("total_freight"),
        F.col("revenue").cast(MONEY_TOTAL).alias("gross_revenue"),
        (F.col("price").cast("double") / F.nullif(F.col("prices"), F.lit(0))).alias("avg_item_price"),
        F.col("highest").alias("max_item_price"),
        F.col("lowest").alias("min_item_price"),
    )


def int_order_items_rolled_up(items: DataFrame, one_shuffle: bool = False) -> DataFrame:
    """Counts, sums and prices per order.

    Two distinct counts in one aggregate would send every item through the shuffle three times, at
    full width. Here each count runs by itself over the two columns it needs; the union of the three
    parts stays partitioned by order_id, so putting them together moves no data. With `one_shuffle`
    items move once, which takes less than half the bytes, but no order is then split among tasks.
    """
    if one_shuffle:
        return items_from_one_shuffle(items)
    totals = order_item_totals(items)
    products = items.groupBy("order_id").agg(F.count_distinct("product_id").alias("distinct_product_count"))
    sellers = items.groupBy("order_id").agg(F.count_distinct("seller_id").alias("distinct_seller_count"))
    parts = totals.unionByName(products, allowMissingColumns=True).unionByName(sellers, allowMissingColumns=True)
    columns = (
        "item_count",
        "distinct_product_count",
        "distinct_seller_count",
        "gross_item_revenue",
        "total_freight",
        "gross_revenue",
        "avg_item_price",
        "max_item_price",
        "min_item_price",
    )
    # Each column comes from one row per order, so max only picks it out.
    return parts.groupBy("order_id").agg(*(F.max(c).alias(c) for c in columns))


def dominant_type() -> Column:
    """Payment type of the highest amount; the lowest sequence wins a tie, a null amount comes last."""
    amount, sequence = F.col("payment_amount"), F.col("installment_sequence")
    rank = F.struct(amount.isNull(), -amount, sequence.isNull(), sequence)
    return F.min_by("payment_type", rank)


def int_payments_rolled_up(payments: DataFrame) -> DataFrame:
    """One pass for all payment facts of an order.

    Two types differ exactly if the least and the greatest do, which spares a distinct count.
    Payments without an order have no dominant type, as no order could be matched to them.
    """
    kind = F.col("payment_type")
    several = F.coalesce(F.min(kind) != F.max(kind), F.lit(False))
    return payments.groupBy("order_id").agg(
        money_sum(F.col("payment_amount")).alias("total_payment_amount"),
        F.count(F.lit(1)).alias("payment_record_count"),
        F.max("installment_count").alias("max_installments"),
        several.alias("is_multi_payment_method"),
        F.when(F.col("order_id").isNotNull(), dominant_type()).alias("primary_payment_type"),
    )


def primary_payment_type(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(dominant_type().alias("primary_payment_type"))
