"""Roll-ups on ties, nulls and repeated values."""

from __future__ import annotations

from decimal import Decimal

from orderlake.operators import rollups

PAYMENTS = """order_id string, installment_sequence bigint, payment_type string, installment_count int,
    payment_amount decimal(10,2)"""


def rolled(spark, *rows):
    data = [("o", s, t, n, None if a is None else Decimal(a)) for s, t, n, a in rows]
    return rollups.int_payments_rolled_up(spark.createDataFrame(data, PAYMENTS)).first()


def test_highest_amount_is_dominant(spark):
    row = rolled(spark, (1, "boleto", 1, "5.00"), (2, "voucher", 3, "7.00"))
    assert (row.primary_payment_type, row.total_payment_amount) == ("voucher", Decimal("12.00"))
    assert (row.payment_record_count, row.max_installments, row.is_multi_payment_method) == (2, 3, True)


def test_lowest_sequence_wins_a_tie(spark):
    row = rolled(spark, (3, "boleto", 1, "5.00"), (2, "voucher", 1, "5.00"), (4, "debit_card", 1, "5.00"))
    assert row.primary_payment_type == "voucher"


def test_null_amount_comes_last(spark):
    assert rolled(spark, (1, "boleto", 1, None), (2, "voucher", 1, "-1.00")).primary_payment_type == "voucher"
    assert rolled(spark, (2, "boleto", 1, None), (1, "voucher", 1, None)).primary_payment_type == "voucher"


def test_dominant_type_may_be_null(spark):
    assert rolled(spark, (1, None, 1, "9.00"), (2, "voucher", 1, "1.00")).primary_payment_type is None


def test_several_methods(spark):
    assert rolled(spark, (1, "boleto", 1, "1.00"), (2, "boleto", 1, "2.00")).is_multi_payment_method is False
    assert rolled(spark, (1, "boleto", 1, "1.00"), (2, None, 1, "2.00")).is_multi_payment_method is False
    assert rolled(spark, (1, None, 1, "1.00")).is_multi_payment_method is False


def test_items(spark):
    rows = [
        ("a", "p1", "s1", "10.00", "1.00", "11.00"),
        ("a", "p1", "s2", "20.00", "2.00", "22.00"),
        ("a", "p2", "s2", None, "3.00", None),
        ("b", None, "s1", None, None, None),
        (None, "p1", "s1", "1.00", "1.00", "2.00"),
        (None, "p2", "s1", "1.00", "1.00", "2.00"),
    ]
    rows = [(*r[:3], *(None if v is None else Decimal(v) for v in r[3:])) for r in rows]
    items = spark.createDataFrame(
        rows,
        """order_id string, product_id string, seller_id string, item_price decimal(10,2),
        freight_value decimal(10,2), total_item_revenue decimal(11,2)""",
    )
    got = {r.order_id: r for r in rollups.int_order_items_rolled_up(items).collect()}
    a, b, orphan = got["a"], got["b"], got[None]
    assert (a.item_count, a.distinct_product_count, a.distinct_seller_count) == (3, 2, 2)
    assert (a.gross_item_revenue, a.total_freight, a.gross_revenue) == (
        Decimal("30.00"), Decimal("6.00"), Decimal("33.00"),
    )
    assert (a.avg_item_price, a.max_item_price, a.min_item_price) == (15.0, Decimal("20.00"), Decimal("10.00"))
    assert (b.item_count, b.distinct_product_count, b.distinct_seller_count) == (1, 0, 1)
    assert b.gross_item_revenue is None and b.avg_item_price is None
    assert (orphan.item_count, orphan.distinct_product_count, orphan.distinct_seller_count) == (2, 2, 1)
    assert len(got) == 3
