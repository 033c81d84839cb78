"""CSV ingest and the sinks."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import partial

import pytest

from orderlake.__main__ import main
from orderlake.operators.checks import check_report, status_counts
from orderlake.operators.dimensions import date_range
from orderlake.operators.metrics import metric_query
from orderlake.plans.build import LOADED_AT, STAMPED, Stored, build, create_views, ingest
from orderlake.plans.star import MARTS, STAGING, Star
from orderlake.sources import tables
from orderlake.sources.csv_files import file_name, read_csv, read_csv_folder
from orderlake.sources.schemas import RAW_TABLES
from tests.shop import ROWS, shop

FILES = {
    "orders": '''order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
"o1","c1",delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00
"o2","c1",shipped,2018-07-24 20:41:37,,,,2018-08-13 00:00:00
''',
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72
o1,2,p1,s1,2017-10-06 11:07:15,1.005,0
""",
    # Another column order, and a column that the schema does not know.
    "customers": """customer_unique_id,customer_id,extra,customer_zip_code_prefix,customer_city,customer_state
u1,c1,x,01409,"sao paulo, centro",SP
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,perfumaria,40,287,1,225,16,10,14
p2,,,,,,,,
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,09080,santo andre,SP
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,2,39.72
""",
    "order_reviews": '''review_id,order_id,review_score,review_comment_title,review_comment_message
r1,o1,5,,"first line
second ""line"", end"
r2,o1,1,ok,
''',
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01037,-23.54562128115268,-46.63929204800168,sao paulo,SP
""",
    # Saved with a byte-order mark, as spreadsheet programs do.
    "product_category_name_translation": """﻿product_category_name,product_category_name_english
perfumaria,perfumery
""",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / file_name(name, "shop_")).write_text(text, encoding="utf-8")
    return tmp_path


def test_file_names():
    assert file_name("orders", "shop_") == "shop_orders_dataset.csv"
    assert file_name("orders") == "orders_dataset.csv"
    assert file_name("product_category_name_translation", "shop_") == "product_category_name_translation.csv"


def test_columns_by_name_and_type(spark, folder):
    raw = read_csv_folder(spark, str(folder), "shop_")
    assert set(raw) == set(RAW_TABLES)
    first, second = raw["orders"].orderBy("order_id").collect()
    assert first.order_purchase_timestamp == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert second.order_approved_at is None
    customer = raw["customers"].first()
    assert (customer.customer_id, customer.customer_zip_code_prefix) == ("c1", "01409")
    assert (customer.customer_city, customer.extra) == ("sao paulo, centro", "x")
    prices = [r.price for r in raw["order_items"].orderBy("order_item_id").collect()]
    assert prices == [Decimal("29.99"), Decimal("1.01")]
    review = raw["order_reviews"].filter("review_id = 'r1'").first()
    assert review.review_comment_message == 'first line\nsecond "line", end'
    assert raw["order_reviews"].count() == 2
    assert raw["products"].filter("product_category_name is null").count() == 1
    assert raw["product_category_name_translation"].columns[0] == "product_category_name"


def test_absent_files_are_named(spark, folder):
    with pytest.raises(FileNotFoundError, match="other_orders_dataset.csv.*other_sellers_dataset.csv"):
        read_csv_folder(spark, str(folder), "other_")


def test_absent_column(spark, tmp_path):
    (tmp_path / "sellers_dataset.csv").write_text("seller_id,seller_city\ns1,x\n")
    with pytest.raises(ValueError, match="seller_state"):
        read_csv(spark, str(tmp_path / "sellers_dataset.csv"), "sellers")


def test_bad_text_fails(spark, tmp_path):
    bad = FILES["order_payments"].replace("39.72", "much")
    (tmp_path / "order_payments_dataset.csv").write_text(bad)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, str(tmp_path / "order_payments_dataset.csv"), "order_payments").collect()


def sinks(spark, folder):
    def save(df, name):
        tables.save_to_folder(df, str(folder), name)

    return save, partial(tables.read_from_folder, spark, str(folder))


def test_files_to_metrics(spark, folder, tmp_path):
    """Ingest, build, check and query, twice: a second run replaces everything."""
    save_raw, read_raw = sinks(spark, tmp_path / "raw")
    save, read = sinks(spark, tmp_path / "marts")
    for _ in range(2):
        counts = {r.table_name: r.row_count for r in ingest(spark, str(folder), save_raw, read_raw, "shop_").collect()}
        assert counts["order_items"] == counts["orders"] == 2 and len(counts) == 9
        star = Star({name: read_raw(name) for name in RAW_TABLES}, date_range(spark, "2017-01-01", "2019-01-01"))
        build(star, save)
    stored = Stored(read, star)
    assert metric_query(stored, ["revenue"]).first().revenue == Decimal("39.72")
    statuses = {r.status: r.checks for r in status_counts(check_report(spark, stored)).collect()}
    assert statuses == {"pass": 84}


def test_built_marts_equal_lazy_ones(spark, tmp_path):
    star = Star(shop(spark), date_range(spark, "2018-01-01", "2019-01-01"))
    save, read = sinks(spark, tmp_path)
    build(star, save)
    stored = Stored(read)
    for name in MARTS:
        assert (LOADED_AT in stored[name].columns) == (name in STAMPED)
        lazy, built = star[name], stored[name].drop(LOADED_AT)
        assert built.dtypes == lazy.dtypes
        assert lazy.exceptAll(built).isEmpty() and built.exceptAll(lazy).isEmpty()
    asked = (["revenue", "unique_customers", "cumulative_revenue"], ["metric_time__month"])
    assert sorted(metric_query(stored, *asked).collect()) == sorted(metric_query(star, *asked).collect())


def test_catalog_tables_and_views(spark):
    star = Star(shop(spark), date_range(spark))
    try:
        for rows in (ROWS["sellers"], ROWS["sellers"][:1]):
            small = Star(shop(spark, sellers=rows), date_range(spark))
            build(small, partial(save_named, "marts"), ["dim_sellers"])
            assert tables.read_from_database(spark, "marts", "dim_sellers").count() == len(rows)
        create_views(star)
        assert {t.name for t in spark.catalog.listTables()} >= set(STAGING)
        assert spark.sql("select count(*) from stg_orders where is_delivered").first()[0] == 1
    finally:
        spark.sql("drop database if exists marts cascade")
        for name in STAGING:
            spark.catalog.dropTempView(name)


def save_named(database, df, name):
    tables.save_to_database(df, database, name)


def test_command_line(spark, folder, tmp_path, capsys):
    raw, marts = ["--raw", str(tmp_path / "raw")], ["--marts", str(tmp_path / "marts")]
    assert main(["ingest", "--files", str(folder), "--prefix", "shop_", *raw]) == 0
    assert main(["build", *raw, *marts]) == 0
    assert main(["check", *raw, *marts]) == 0
    assert "PASS=84 WARN=0 ERROR=0" in capsys.readouterr().out
    assert main(["query", *marts, "--metrics", "revenue,order_count", "--group-by", "metric_time__year"]) == 0
    assert "2017-01-01\t39.72\t1\n" in capsys.readouterr().out
    assert main(["query", *marts, "--metrics", "revenue"]) == 0
    assert capsys.readouterr().out.splitlines()[-2] == "revenue"
    days = ["query", *marts, "--metrics", "cumulative_revenue", "--group-by", "metric_time", "--every-period"]
    assert main([*days, "--out", str(tmp_path / "out")]) == 0
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert main(days) == 0
    assert len(capsys.readouterr().out.splitlines()) - 1 == stored.count()
    assert main(["build", *raw, *marts, "--start", "2018-01-01"]) == 0
    assert main(["check", *raw, *marts]) == 1
    assert main(["list"]) == 0
    assert "cumulative_revenue" in capsys.readouterr().out
    for name in STAGING:
        spark.catalog.dropTempView(name)


def test_command_line_over_more_rows_than_fit_a_screen(spark, tmp_path, capsys):
    """Every row of a long result is printed, and stored."""
    marts = str(tmp_path / "marts")
    star = Star(shop(spark), date_range(spark, "2010-01-01", "2020-01-01"))
    build(star, partial(lambda folder, df, name: tables.save_to_folder(df, folder, name), marts))
    long = spark.sql("select id as order_id, cast(id as decimal(38,2)) as gross_revenue from range(3000)")
    facts = tables.read_from_folder(spark, marts, "fct_orders").drop("order_id", "gross_revenue").limit(1).crossJoin(long)
    tables.save_to_folder(facts, str(tmp_path / "many"), "fct_orders")
    query = ["query", "--marts", str(tmp_path / "many"), "--metrics", "revenue", "--group-by", "order"]
    assert main([*query, "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3000
    assert main(query) == 0
    assert len(capsys.readouterr().out.splitlines()) == 3001


def test_command_line_over_databases(spark, folder, capsys):
    places = ["--raw", "database:cli_raw", "--marts", "database:cli_marts"]
    try:
        assert main(["ingest", "--files", str(folder), "--prefix", "shop_", *places[:2]]) == 0
        assert main(["build", *places, "--staging", "cli_staging"]) == 0
        assert spark.table("cli_staging.stg_orders").count() == spark.table("cli_raw.orders").count()
        assert {t.tableType for t in spark.catalog.listTables("cli_staging") if not t.isTemporary} == {"VIEW"}
        assert main(["check", *places]) == 0
        assert main(["query", *places[2:], "--metrics", "order_count"]) == 0
    finally:
        for name in ("cli_raw", "cli_marts", "cli_staging"):
            spark.sql(f"drop database if exists {name} cascade")
        for name in STAGING:
            spark.catalog.dropTempView(name)
