"""All item and order queries on tables where one order, customer, product and seller hold a third."""

from __future__ import annotations

import pytest

from orderlake.plans.queries import ORACLE_SQL, QUERIES
from orderlake.sources import driver_tables
from tests.compare import TABLES, assert_same, connect

SOURCE = "/root/testdata/sf0.001"

CASES = (
    "ingest_row_counts",
    "stg_order_items",
    "stg_payments",
    "int_order_items_rolled_up",
    "int_payments_rolled_up",
    "fct_orders",
    "fct_order_items",
    "fct_payments",
    "metric_totals",
    "metric_avg_order_value_by_payment_type",
    "metric_revenue_per_customer",
    "metric_cumulative_revenue_by_quarter_and_status",
    "check_unique",
    "check_relationships_orders_without_items",
    "assert_order_revenue_matches_payments",
    "check_report",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the lines goes to one order, product and seller, half of them as exact copies of
    one line; a third of the orders goes to one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        if name == "lineitem":
            hot = "l_linenumber % 3 = 0"
            df = df.selectExpr(
                f"if({hot}, 6L, l_orderkey) l_orderkey",
                f"if({hot}, 7L, l_partkey) l_partkey",
                f"if({hot}, 8L, l_suppkey) l_suppkey",
                "l_linenumber",
                "l_quantity",
                f"if({hot} and l_linenumber = 3, 1000.5D, l_extendedprice) l_extendedprice",
                f"if({hot} and l_linenumber = 3, 0.05D, l_discount) l_discount",
                f"if({hot} and l_linenumber = 3, 0.02D, l_tax) l_tax",
                "l_returnflag",
                "l_linestatus",
                f"if({hot} and l_linenumber = 3, timestamp_ntz'1998-01-01 00:00:00', l_shipdate) l_shipdate",
            )
        if name == "orders":
            df = df.selectExpr("o_orderkey", "if(o_orderkey % 3 = 0, 1L, o_custkey) o_custkey", *df.columns[2:])
        df.repartition(8).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed, "/*.parquet")


@pytest.mark.parametrize("name", CASES)
def test_skewed_tables(spark, skewed, duck, name):
    assert_same(QUERIES[name](spark, skewed), duck, ORACLE_SQL[name])


def final_plan(df) -> str:
    """The plan as adaptive execution ran it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fct_order_items", "fct_orders"])
def test_joins_split_hot_keys(spark, skewed, name):
    """With thresholds to the size of the tables, the join on the hot key runs in several tasks."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        assert "skew=true" in final_plan(QUERIES[name](spark, skewed))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_replaced_table_is_read_anew(spark, tmp_path):
    one = spark.read.parquet(f"{SOURCE}/lineitem.parquet")
    for rows in (one, one.withColumn("l_partkey", one.l_partkey + 1), one.unionByName(one)):
        rows.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
        items = driver_tables.DriverTables(spark, str(tmp_path))["order_items"]
        assert int(items.agg({"order_item_id": "max"}).first()[0][7:19]) == rows.filter(
            "l_linenumber = 7"
        ).agg({"l_partkey": "max"}).first()[0]
        assert items.count() == rows.count()
