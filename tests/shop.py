"""A small shop in the raw schemas, with orphans and gaps."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from orderlake.sources.schemas import RAW_SCHEMAS


def at(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


ROWS: dict[str, list[tuple]] = {
    "orders": [
        ("late", "c1", "delivered", at("2018-01-01 22:00:00"), at("2018-01-01 23:00:00"), at("2018-01-03"),
         at("2018-01-10 08:00:00"), at("2018-01-05")),
        ("paid", "c2", "shipped", at("2018-01-31 10:00:00"), at("2018-01-31 11:00:00"), at("2018-02-01"), None,
         at("2018-02-20")),
        ("canceled", "c3", "canceled", at("2018-04-02 12:00:00"), None, None, None, None),
        ("empty", "c1", "unavailable", at("2018-02-10 09:00:00"), None, None, None, at("2018-02-12")),
        ("stranger", "c9", "created", at("2018-01-01 00:00:00"), None, None, None, None),
    ],
    "order_items": [
        ("late", 1, "p1", "s1", at("2018-01-04"), Decimal("10.00"), Decimal("1.50")),
        ("late", 2, "p2", "s1", at("2018-01-04"), Decimal("20.00"), Decimal("2.50")),
        ("paid", 1, "p1", "s2", at("2018-02-03"), Decimal("30.00"), Decimal("0.00")),
        ("stranger", 1, "p1", "s1", None, Decimal("10.00"), Decimal("1.00")),
        ("nowhere", 1, "p1", "s1", None, Decimal("99.00"), Decimal("9.00")),
    ],
    "customers": [
        ("c1", "ann", "01001", "sao paulo", "SP"),
        ("c2", "bob", "20000", "rio de janeiro", "RJ"),
        ("c3", "ann", "01002", "campinas", "SP"),
    ],
    "products": [
        ("p1", "moveis", 5, 50, 1, Decimal("100.00"), Decimal("10.00"), Decimal("10.00"), Decimal("10.00")),
        ("p2", None, None, None, None, None, None, None, None),
    ],
    "sellers": [("s1", "01001", "sao paulo", "SP"), ("s2", "69000", "manaus", "AM")],
    "order_payments": [
        ("late", 1, "credit_card", 4, Decimal("34.00")),
        ("late", 2, "voucher", 1, Decimal("2.00")),
        ("paid", 1, "boleto", 0, Decimal("30.00")),
        ("canceled", 1, "boleto", 1, Decimal("7.00")),
        ("stranger", 1, "boleto", 1, Decimal("11.00")),
        ("nowhere", 1, "boleto", 1, Decimal("99.00")),
    ],
    "order_reviews": [("r1", "late", 1), ("r2", "late", 5)],
    "geolocation": [("01001", -23.5, -46.6, "sao paulo", "SP")],
    "product_category_name_translation": [("moveis", "furniture")],
}


def ddl(table: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in RAW_SCHEMAS[table].items())


def shop(spark: SparkSession, **changed: list[tuple]) -> dict[str, DataFrame]:
    """All raw tables; `changed` replaces the rows of some."""
    return {table: spark.createDataFrame(changed.get(table, rows), ddl(table)) for table, rows in ROWS.items()}
