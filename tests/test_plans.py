"""What the physical plans must and must not hold."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pytest

from orderlake import session
from orderlake.operators.checks import check_report
from orderlake.plans.build import Stored
from orderlake.plans.queries import QUERIES, star_over
from orderlake.plans.star import MARTS, Star
from orderlake.sources.schemas import RAW_TABLES

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*?)>", text)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    # Turning the one row of totals into rows is an Expand as well.
    expands = () if name == "list_metrics" else ("Expand",)
    for unwanted in ("Python", "CartesianProduct", "NestedLoopJoin", *expands):
        assert unwanted not in text, unwanted


def test_revenue_reads_few_columns(spark):
    read = scans(plan(QUERIES["metric_revenue_by_month"](spark, FOLDER)))
    assert sorted(read) == [
        "l_orderkey:bigint,l_extendedprice:double,l_discount:double",
        "o_orderkey:bigint,o_orderdate:timestamp_ntz",
    ]


@pytest.mark.parametrize("name", ["stg_order_items", "stg_payments"])
def test_sequences_come_from_the_row_alone(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Window" not in text and "Exchange" not in text


def test_queries_start_no_job_while_they_are_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for name in ("ingest_row_counts", "stg_order_items", "check_report", "metric_cumulative_revenue"):
            QUERIES[name](spark, FOLDER)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_report_reads_each_stored_table_once(spark, tmp_path):
    star = star_over(spark, FOLDER)
    for name in (*MARTS, *RAW_TABLES):
        star[name].write.parquet(f"{tmp_path}/{name}")
    stored = Stored(lambda name: spark.read.parquet(f"{tmp_path}/{name}"))
    tables = {name: stored[name] for name in (*MARTS, *RAW_TABLES)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(check_report(spark, Stored(stored.read, Star(tables, star.bounds))))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = re.findall(rf"{tmp_path}/(\w+)\]", text)
    assert [read.count(name) for name in ("fct_order_items", "fct_payments", "time_spine")] == [1, 1, 1]
    # Checks of staging columns that are raw ones are those of the raw table.
    assert [read.count(name) for name in ("order_items", "order_payments")] == [1, 1]


def test_running_totals_read_orders_for_sums_and_the_last_period(spark):
    for name in ("metric_cumulative_revenue", "metric_cumulative_revenue_by_quarter_and_status"):
        read = scans(plan(QUERIES[name](spark, FOLDER)))
        # Once more for the calendar, which covers the years of the orders.
        assert sum(r.startswith("o_orderkey") for r in read) <= 3


def test_order_count_reads_orders_only(spark):
    read = scans(plan(QUERIES["metric_order_count_by_status"](spark, FOLDER)))
    assert len(read) == 1 and read[0].startswith("o_orderkey")


def test_roll_up_shuffles_once_per_part(spark):
    """Sums shuffle once; each distinct count shuffles by value, then by order; the union does not."""
    text = plan(star_over(spark, FOLDER)["int_order_items_rolled_up"])
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", text)) == 3
    assert text.count("Exchange hashpartitioning") == 5


def test_payments_are_read_once(spark):
    text = plan(star_over(spark, FOLDER)["int_payments_rolled_up"])
    assert text.count("FileScan") == 1 and "Join" not in text


def test_only_the_running_total_runs_in_one_partition(spark):
    """Without dimensions its window has one partition, of one row per period."""
    for name, query in QUERIES.items():
        windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?) ASC", plan(query(spark, FOLDER)))
        unpartitioned = [w for w in windows if "," not in w]
        assert bool(unpartitioned) == (name in ("metric_cumulative_revenue", "metric_cumulative_revenue_by_month"))


def test_item_fact_shuffles_items_once(spark):
    """Order and customer are joined to each other before they meet the items."""
    text = plan(star_over(spark, FOLDER)["fct_order_items"])
    outermost = re.search(r"(?:BroadcastHash|SortMerge|ShuffledHash)Join \[(\w+)#", text)
    assert outermost.group(1) == "order_id"


def test_partition_settings():
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(2**40, 4000) == 8192
    assert session.shuffle_partitions(100 * 10**12, 4000) == 50_000
    assert session.row_group_bytes(0, 8) == session.row_group_bytes(100 * 10**12, 4000) == 128 * 2**20
    assert session.row_group_bytes(10**7, 8) == 4 * 2**20
    assert session.split_bytes(2**40) == 128 * 2**20
    assert session.split_bytes(100 * 10**12) == 2**30
    assert session.settings(0, 8)["spark.sql.adaptive.skewJoin.enabled"] == "true"


def fake_session(master: str, named: str | None = None):
    conf = SimpleNamespace(get=lambda key: named if key == "spark.checkpoint.dir" else None)
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_shared_folder_is_the_one_the_session_names():
    for master in ("yarn", "local[8]", "local-cluster[2,1,1024]"):
        assert session.shared_folder(fake_session(master, "hdfs://shared/work/")) == "hdfs://shared/work"


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(ValueError):
        session.shared_folder(fake_session(master))
    assert session.shared_folder(fake_session("local[8]")) == session.shared_folder(fake_session("local"))
