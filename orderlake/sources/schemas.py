"""The nine raw tables: names, columns and types.

Ids and zip prefixes are text, so leading zeros survive. Times carry no zone. Two product columns
are misspelt in the data and are matched as they are.
"""

from __future__ import annotations

TEXT, WHOLE, MOMENT, MONEY = "string", "bigint", "timestamp_ntz", "decimal(10,2)"

RAW_SCHEMAS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": TEXT,
        "customer_id": TEXT,
        "order_status": TEXT,
        "order_purchase_timestamp": MOMENT,
        "order_approved_at": MOMENT,
        "order_delivered_carrier_date": MOMENT,
        "order_delivered_customer_date": MOMENT,
        "order_estimated_delivery_date": MOMENT,
    },
    "order_items": {
        "order_id": TEXT,
        "order_item_id": WHOLE,
        "product_id": TEXT,
        "seller_id": TEXT,
        "shipping_limit_date": MOMENT,
        "price": MONEY,
        "freight_value": MONEY,
    },
    "customers": {
        "customer_id": TEXT,
        "customer_unique_id": TEXT,
        "customer_zip_code_prefix": TEXT,
        "customer_city": TEXT,
        "customer_state": TEXT,
    },
    "products": {
        "product_id": TEXT,
        "product_category_name": TEXT,
        "product_name_lenght": WHOLE,
        "product_description_lenght": WHOLE,
        "product_photos_qty": WHOLE,
        "product_weight_g": "decimal(10,2)",
        "product_length_cm": "decimal(10,2)",
        "product_height_cm": "decimal(10,2)",
        "product_width_cm": "decimal(10,2)",
    },
    "sellers": {
        "seller_id": TEXT,
        "seller_zip_code_prefix": TEXT,
        "seller_city": TEXT,
        "seller_state": TEXT,
    },
    "order_payments": {
        "order_id": TEXT,
        "payment_sequential": WHOLE,
        "payment_type": TEXT,
        "payment_installments": "int",
        "payment_value": MONEY,
    },
    "order_reviews": {"review_id": TEXT, "order_id": TEXT, "review_score": "int"},
    "geolocation": {
        "geolocation_zip_code_prefix": TEXT,
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": TEXT,
        "geolocation_state": TEXT,
    },
    "product_category_name_translation": {
        "product_category_name": TEXT,
        "product_category_name_english": TEXT,
    },
}

RAW_TABLES = tuple(RAW_SCHEMAS)
