"""Staging models as lasting views of the catalog.

Spark keeps no DataFrame as a view that outlives the session, so these are the staging models once more as statements over
stored raw tables; the tests hold them against `operators.staging`. A view copies no rows: it reads the raw tables as they
are when it is queried, or, over a folder, the release that was published when it was made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from orderlake.operators.staging import IN_PROGRESS, NO_CATEGORY, SIZES

MONEY = "decimal(10,2)"


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Called with the name of a raw table, it gives what to read it by in a statement.
Relation = Callable[[str], str]

MOMENTS = {
    "purchased_at": "order_purchase_timestamp",
    "approved_at": "order_approved_at",
    "shipped_at": "order_delivered_carrier_date",
    "delivered_at": "order_delivered_customer_date",
    "estimated_delivery_at": "order_estimated_delivery_date",
}


def statements(raw: Relation) -> dict[str, str]:
    """By staging model its query."""
    moments = ", ".join(f"cast({given} as timestamp_ntz) as {name}" for name, given in MOMENTS.items())
    sizes = ", ".join(f"cast(product_{size} as decimal(10,2)) as {size}" for size in SIZES)
    days = "cast(date_diff(cast({} as date), cast(purchased_at as date)) as bigint)"
    price, freight = f"cast(price as {MONEY})", f"cast(freight_value as {MONEY})"
    return {
        "stg_orders": f"""
            select *,
              coalesce(order_status = 'delivered', false) as is_delivered,
              coalesce(order_status = 'canceled', false) as is_canceled,
              coalesce(order_status in ({listed(IN_PROGRESS)}), false) as is_in_progress,
              {days.format("delivered_at")} as delivery_days_actual,
              {days.format("estimated_delivery_at")} as delivery_days_estimated,
              case when delivered_at is not null then coalesce(delivered_at > estimated_delivery_at, false) end
                as is_late_delivery
            from (select order_id, customer_id, order_status, {moments} from {raw("orders")})""",
        "stg_order_items": f"""
            select order_id, order_item_id as item_sequence, product_id, seller_id,
              cast(shipping_limit_date as timestamp_ntz) as shipping_limit_at,
              {price} as item_price, {freight} as freight_value, {price} + {freight} as total_item_revenue
            from {raw("order_items")}""",
        "stg_customers": f"""
            select customer_id, customer_unique_id, customer_zip_code_prefix as zip_code_prefix,
              customer_city as city, customer_state as state
            from {raw("customers")}""",
        "stg_products": f"""
            select p.product_id,
              coalesce(t.product_category_name_english, p.product_category_name, '{NO_CATEGORY}') as category_name,
              p.product_category_name as category_name_pt, product_name_lenght as name_length,
              product_description_lenght as description_length, product_photos_qty as photos_qty, {sizes}
            from {raw("products")} p left join {raw("product_category_name_translation")} t
              on p.product_category_name = t.product_category_name""",
        "stg_sellers": f"""
            select seller_id, seller_zip_code_prefix as zip_code_prefix, seller_city as city, seller_state as state
            from {raw("sellers")}""",
        "stg_payments": f"""
            select order_id, payment_sequential as installment_sequence, payment_type,
              cast(payment_installments as int) as installment_count, cast(payment_value as {MONEY}) as payment_amount
            from {raw("order_payments")}""",
    }


def create_staging(spark: SparkSession, database: str, raw: Relation) -> None:
    """Create or replace the six staging views in a database."""
    spark.sql(f"create database if not exists `{database}`")
    for name, query in statements(raw).items():
        spark.sql(f"create or replace view `{database}`.`{name}` as {query}")
