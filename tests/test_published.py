"""Refreshes that fail, and what is kept of tables when they are written."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlake.operators.checks import CHECKS, ROWS, all_violations, as_they_run, check_report, counters, stored_report
from orderlake.operators.dimensions import date_range
from orderlake.plans.build import Stored, build, checked_sink, facts_of, refresh
from orderlake.plans.staging_views import create_staging
from orderlake.plans.star import MARTS, STAGING, Star
from orderlake.sources.published import PublishedDatabase, PublishedFolder, published
from orderlake.sources.schemas import RAW_TABLES
from orderlake.sources.tables import row_counts
from tests.shop import ROWS as SHOP
from tests.shop import at, shop


def star_of(spark, **changed):
    return Star(shop(spark, **changed), date_range(spark, "2018-01-01", "2019-01-01"))


def sellers(n):
    return SHOP["sellers"][:n]


def failing(star):
    """One mart breaks while its rows are computed."""
    star._made["fct_payments"] = star["fct_payments"].withColumn("order_id", F.raise_error(F.lit("broken")))
    return star


def rows_of(snapshot):
    return {name: sorted(map(str, snapshot.read(name).collect())) for name in MARTS}


@pytest.fixture(params=["folder", "database"])
def place(request, spark, tmp_path):
    if request.param == "folder":
        yield PublishedFolder(spark, str(tmp_path))
        return
    yield PublishedDatabase(spark, "published_marts")
    spark.sql("drop database if exists published_marts cascade")


def test_a_failed_refresh_leaves_the_old_tables(spark, place):
    before = refresh(place, lambda save: build(star_of(spark), save))
    kept = rows_of(before)
    with pytest.raises(Exception, match="broken"):
        refresh(place, lambda save: build(failing(star_of(spark, sellers=sellers(1))), save))
    assert rows_of(place.snapshot()) == rows_of(before) == kept
    after = refresh(place, lambda save: build(star_of(spark, sellers=sellers(1)), save))
    assert after.read("dim_sellers").count() == 1 < len(kept["dim_sellers"])


def test_a_reader_keeps_to_the_tables_it_began_with(spark, tmp_path):
    place = PublishedFolder(spark, str(tmp_path))
    early = refresh(place, lambda save: build(star_of(spark), save))
    late = refresh(place, lambda save: build(star_of(spark, sellers=sellers(1)), save))
    assert early.read("dim_sellers").count() == len(SHOP["sellers"])
    assert late.read("dim_sellers").count() == 1


def test_an_interrupted_entry_is_not_seen(spark, tmp_path):
    """Files of an entry that was not completed, as an interrupted write leaves them."""
    place = PublishedFolder(spark, str(tmp_path))
    refresh(place, lambda save: build(star_of(spark), save, ["dim_sellers"]))
    cut = tmp_path / "published" / "number=000000000002-x" / "_temporary" / "0"
    cut.mkdir(parents=True)
    (cut / "part-0.parquet").write_bytes(b"PAR1")
    assert place.snapshot().read("dim_sellers").count() == len(SHOP["sellers"])


def test_tables_of_other_refreshes_stay(spark, place):
    refresh(place, lambda save: build(star_of(spark), save, ["dim_sellers", "dim_dates"]))
    later = refresh(place, lambda save: build(star_of(spark, sellers=sellers(1)), save, ["dim_sellers"]))
    assert later.read("dim_sellers").count() == 1 and later.read("dim_dates").count() == 365
    assert set(later.facts) == {"dim_sellers", "dim_dates"}


def test_old_releases_can_be_dropped(spark, tmp_path):
    place = PublishedFolder(spark, str(tmp_path))
    for n in (1, 2, 1):
        refresh(place, lambda save, n=n: build(star_of(spark, sellers=sellers(n)), save, ["dim_sellers"]))
    place.release().save(spark.range(1), "left_over")
    assert len(place.drop_old(keep=1)) == 3
    assert place.snapshot().read("dim_sellers").count() == 1
    assert len(list((tmp_path / "releases").iterdir())) == 1


def test_old_tables_of_a_database_can_be_dropped(spark):
    place = PublishedDatabase(spark, "dropped")
    try:
        for n in (1, 2):
            refresh(place, lambda save, n=n: build(star_of(spark, sellers=sellers(n)), save, ["dim_sellers"]))
        assert len(place.drop_old()) == 1
        assert place.snapshot().read("dim_sellers").count() == 2
    finally:
        spark.sql("drop database if exists dropped cascade")


def test_a_folder_without_entries_is_read_as_it_is(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/dim_sellers")
    assert published(spark, str(tmp_path)).snapshot().read("dim_sellers").count() == 3


def test_a_table_gives_way_to_a_view(spark):
    """A database that holds plain tables, as earlier runs left them."""
    try:
        spark.sql("create database old_marts")
        spark.range(3).write.saveAsTable("old_marts.dim_sellers")
        after = refresh(published(spark, "database:old_marts"), lambda save: build(star_of(spark), save, ["dim_sellers"]))
        assert after.read("dim_sellers").count() == len(SHOP["sellers"])
    finally:
        spark.sql("drop database if exists old_marts cascade")


BAD = {
    "orders": [*SHOP["orders"], SHOP["orders"][0], (None, "c1", "lost", at("2020-01-01"), None, None, None, None)],
    "order_reviews": [*SHOP["order_reviews"], ("r3", "late", 6), ("r4", "late", 6), ("r5", "late", 0)],
    "customers": [*SHOP["customers"], ("c1", None, "1", "x", None)],
}


@pytest.mark.parametrize("changed", [{}, BAD], ids=["as given", "with faults"])
def test_stored_report_equals_the_lazy_one(spark, tmp_path, changed):
    star = star_of(spark, **changed)
    want = {r.check: (r.violations, r.status) for r in check_report(spark, star).collect()}
    raw = refresh(PublishedFolder(spark, f"{tmp_path}/raw"), lambda save: build(star, save, RAW_TABLES))
    over_raw = Star({name: raw.read(name) for name in RAW_TABLES}, star.bounds)
    marts = refresh(PublishedFolder(spark, f"{tmp_path}/marts"), lambda save: build(over_raw, save))
    facts = facts_of(raw, marts)
    assert set(facts) == {*RAW_TABLES, *MARTS}
    report = stored_report(spark, Stored(marts.read, over_raw), facts=facts).collect()
    assert [r.check for r in report] == [c.name for c in CHECKS]
    assert {r.check: (r.violations, r.status) for r in report} == want
    assert {r.check: r.violations for r in stored_report(spark, Stored(marts.read, over_raw)).collect()} == {k: v for k, (v, _) in want.items()}


def test_counters_are_what_the_checks_find(spark, tmp_path):
    star = star_of(spark, **BAD)
    release = PublishedFolder(spark, str(tmp_path)).release()
    build(star, checked_sink(release), ["orders", "fct_orders"])
    known = release.facts["orders"]
    assert known[ROWS] == len(BAD["orders"]) and known["not_null:orders.order_id"] == 1
    assert known["accepted_values:orders.order_status"] == 1
    assert set(release.facts["fct_orders"]) == {ROWS, *(c.name for c in CHECKS if c.table == "fct_orders" and c.kind not in ("unique", "relationships"))}


def test_counters_that_do_not_fit_the_table_are_not_trusted(spark, tmp_path):
    """Rows that came to a table later, or counters that were told wrong: the checks read the table."""
    star = star_of(spark)
    place = PublishedFolder(spark, str(tmp_path))
    snapshot = refresh(place, lambda save: build(star, save, ["orders", "dim_sellers"]))
    bad = spark.createDataFrame([(None, "c1", "lost", *[None] * 5)], snapshot.read("orders").schema)
    bad.write.mode("append").parquet(place.path("orders", snapshot.releases["orders"]))
    rules = [c for c in CHECKS if c.table in ("orders", "dim_sellers") and c.kind != "relationships"]
    report = stored_report(spark, {n: snapshot.read(n) for n in snapshot.facts}, rules, facts_of(snapshot)).collect()
    found = {r.check: r.violations for r in report if r.violations}
    assert found == {"not_null:orders.order_id": 1, "not_null:orders.order_purchase_timestamp": 1, "accepted_values:orders.order_status": 1}


def test_the_report_scans_stored_tables_for_keys_and_references_only(spark, tmp_path):
    star = star_of(spark)
    raw = refresh(PublishedFolder(spark, f"{tmp_path}/raw"), lambda save: build(star, save, RAW_TABLES))
    over_raw = Star({name: raw.read(name) for name in RAW_TABLES}, star.bounds)
    marts = refresh(PublishedFolder(spark, f"{tmp_path}/marts"), lambda save: build(over_raw, save))
    _, numbered, told = as_they_run(CHECKS, facts_of(raw, marts))
    assert {c.kind for c in numbered.values()} == {"unique", "relationships", "not_null"} and len(told) > 30
    assert {c.table for c in numbered.values() if c.kind == "not_null"} == {"stg_products"}
    parts = all_violations(numbered, Stored(marts.read, over_raw), hashed=True)
    text = "".join(df._jdf.queryExecution().executedPlan().toString() for df in parts)
    for spared in ("gross_revenue", "order_status", "weight_bucket", "installment_bucket", "payment_type", "review_score"):
        assert spared not in text
    assert "order_key" in text and "customer_key" in text


def test_row_counts_read_no_column(spark, tmp_path):
    """Counts come from the footers of stored tables."""
    snapshot = refresh(PublishedFolder(spark, str(tmp_path)), lambda save: build(star_of(spark), save))
    counted = row_counts({name: snapshot.read(name) for name in MARTS})
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReadSchema: struct<>") == text.count("FileScan") == len(MARTS)
    assert {r.table_name: r.row_count for r in counted.collect()} == {n: known[ROWS] for n, known in snapshot.facts.items()}


def test_staging_views_outlive_the_frames_and_copy_nothing(spark, tmp_path):
    star = star_of(spark)
    raw = refresh(PublishedFolder(spark, f"{tmp_path}/raw"), lambda save: build(star, save, RAW_TABLES))
    base = refresh(PublishedDatabase(spark, "view_raw"), lambda save: build(star, save, RAW_TABLES))
    try:
        for snapshot in (raw, base):
            create_staging(spark, "view_staging", snapshot.relation)
            kinds = {t.name: t.tableType for t in spark.catalog.listTables("view_staging")}
            assert kinds == dict.fromkeys(STAGING, "VIEW")
            for name in STAGING:
                view, model = spark.table(f"view_staging.{name}"), star[name]
                assert view.dtypes == model.dtypes
                assert view.exceptAll(model).isEmpty() and model.exceptAll(view).isEmpty()
        assert not list(Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")).glob("view_staging.db/*"))
    finally:
        for name in ("view_raw", "view_staging"):
            spark.sql(f"drop database if exists {name} cascade")


def test_counters_need_no_key(spark):
    assert [c._jc.toString() for c in counters("geolocation")] == [F.count(F.lit(1)).alias(ROWS)._jc.toString()]
