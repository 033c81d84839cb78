"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.keys import surrogate_key
from orderlake.functions.numbers import money_sum
from orderlake.operators import checks, dimensions, metrics, rollups
from orderlake.plans import oracle
from orderlake.plans.build import LOADED_AT, Stored, build, refresh
from orderlake.plans.star import MARTS, STAGING, Star
from orderlake.session import shared_folder
from orderlake.sources.csv_files import file_name, read_csv
from orderlake.sources.driver_tables import LINE_SEQUENCE, DriverTables
from orderlake.sources.published import PublishedFolder
from orderlake.sources.tables import row_counts

Query = Callable[[SparkSession, str], DataFrame]

# Metric queries without running totals: name -> (metrics, group-by names).
METRIC_QUERIES: dict[str, tuple[list[str], list[str]]] = {
    "metric_revenue_by_month": (["revenue"], ["metric_time__month"]),
    "metric_item_revenue": (["item_revenue"], ["metric_time__quarter"]),
    "metric_freight_cost": (["freight_cost"], ["metric_time__year"]),
    "metric_order_count_by_status": (["order_count"], ["order__order_status"]),
    "metric_order_count_by_day": (["order_count"], ["metric_time__day"]),
    "metric_items_sold": (["items_sold"], ["order__is_delivered"]),
    "metric_unique_customers": (["unique_customers"], ["order_date__month"]),
    "metric_canceled_orders": (["canceled_orders"], ["metric_time__month"]),
    "metric_delivered_orders": (["delivered_orders"], ["metric_time__week"]),
    "metric_avg_order_value_by_payment_type": (["avg_order_value"], ["orders__payment_type"]),
    "metric_avg_items_per_order": (["avg_items_per_order"], ["customer__customer_city"]),
    "metric_cancellation_rate_by_quarter": (["cancellation_rate"], ["metric_time__quarter"]),
    "metric_delivery_completion_rate": (["delivery_completion_rate"], ["metric_time__year"]),
    "metric_freight_pct": (["freight_pct_of_revenue"], ["order__is_multi_payment_method"]),
    "metric_revenue_per_customer": (["revenue_per_customer"], ["customer__customer_state"]),
    "metric_net_revenue": (["net_revenue"], ["metric_time__month", "order__is_canceled"]),
    "metric_multi_by_year": (["revenue", "order_count", "avg_order_value"], ["metric_time__year"]),
    "metric_revenue_by_customer_state": (["revenue"], ["customer__customer_state"]),
    "metric_revenue_by_zip_and_year": (["revenue", "order_count"], ["customer__customer_zip_prefix", "metric_time__year"]),
    "metric_revenue_by_customer": (["revenue", "order_count"], ["customer"]),
    "metric_payment_sum_by_payment_type": (["payment_sum"], ["orders__payment_type"]),
    "metric_totals": (list(metrics.METRICS), []),
}

CUMULATIVE_QUERIES: dict[str, tuple[list[str], list[str]]] = {
    "metric_cumulative_revenue": (["cumulative_revenue"], ["metric_time"]),
    "metric_cumulative_revenue_by_month": (["cumulative_revenue", "revenue"], ["metric_time__month"]),
    "metric_cumulative_revenue_by_quarter_and_status": (
        ["cumulative_revenue"],
        ["metric_time__quarter", "order__order_status"],
    ),
}


def star_over(spark: SparkSession, folder: str) -> Star:
    """The star schema over the given tables; its calendar is the years that hold all orders."""
    raw = DriverTables(spark, folder)
    return Star(raw, dimensions.years_covering(raw["orders"], "order_purchase_timestamp"))


def on_star(query: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: query(star_over(spark, folder))


def model(name: str) -> Query:
    return on_star(lambda star: star[name])


def metric(names: list[str], group_by: list[str], every_period: bool = False) -> Query:
    return on_star(lambda star: metrics.metric_query(star, names, group_by, every_period))


def list_metrics_with_totals(star: Star) -> DataFrame:
    """The catalogue of metrics, each with its total over all orders."""
    names = list(metrics.METRICS)
    totals = metrics.metric_query(star, names).select(*(F.col(n).cast("double").alias(n) for n in names))
    catalogue = metrics.list_metrics(totals.sparkSession)
    return catalogue.join(totals.unpivot([], names, "name", "total"), "name")


def keys_of_products(star: Star) -> DataFrame:
    """Keys of one column and of two, with nulls among them, and in both orders."""
    return star["stg_products"].select(
        "product_id",
        surrogate_key("product_id").alias("product_key"),
        surrogate_key("category_name_pt").alias("category_key"),
        surrogate_key("product_id", "category_name_pt").alias("product_category_key"),
        surrogate_key("category_name_pt", "product_id").alias("category_product_key"),
    )


def orders_outside_default_calendar(star: Star) -> DataFrame:
    """Order dates against the default calendar, which the given orders mostly miss."""
    orders = star.order_facts(["order_date_key"])
    calendar = dimensions.dim_dates(dimensions.date_range(orders.sparkSession))
    return checks.relationships(orders, "order_date_key", calendar, "date_key")


def distribution(star: Star, table: str, column: str, counted: str) -> DataFrame:
    return star[table].groupBy(column).agg(F.count(F.lit(1)).alias(counted))


def stored_marts(spark: SparkSession, folder: str) -> DataFrame:
    """All marts written as a release, published and read back: rows, rows with a load stamp, and the revenue kept."""
    place = PublishedFolder(spark, f"{shared_folder(spark)}/marts-{uuid.uuid4().hex}")
    stored = Stored(refresh(place, lambda save: build(star_over(spark, folder), save)).read)

    def counted(name: str) -> DataFrame:
        stamped = LOADED_AT in stored[name].columns
        revenue = F.col("gross_revenue") if name == "fct_orders" else F.lit(None).cast("decimal(38,2)")
        return stored[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(F.col(LOADED_AT) if stamped else F.lit(None)).alias("stamped"),
            money_sum(revenue).alias("revenue"),
        )

    return reduce(DataFrame.unionByName, map(counted, MARTS))


def ingested_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The raw reviews, with comments that hold line ends, quotes and commas, through CSV files and the ingest of them."""
    comment = """concat('"', l_returnflag, '" of ', l_partkey, if(l_partkey % 3 = 0, '\\n', ', '), 'from ', l_suppkey, '\\n\\n', l_linestatus)"""
    lines = DriverTables(spark, folder).file("lineitem").filter("l_linenumber = 1")
    reviews = lines.selectExpr(
        f"concat_ws('-', l_orderkey, {LINE_SEQUENCE}) as review_id",
        "cast(l_orderkey as string) as order_id",
        "cast(1 + l_partkey % 5 as int) as review_score",
        f"{comment} as review_comment_message",
    )
    path = f"{shared_folder(spark)}/{file_name('order_reviews', f'{uuid.uuid4().hex}_')}"
    reviews.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return read_csv(spark, path, "order_reviews")


def unique_customers_by_grain(spark: SparkSession, folder: str) -> DataFrame:
    """Persons who ordered, by day, week, month, quarter and year, from one pass over the orders."""
    star, path = star_over(spark, folder), f"{shared_folder(spark)}/numbers-{uuid.uuid4().hex}"
    number = F.monotonically_increasing_id().alias("number")
    star["dim_customers"].select("customer_unique_id", number).write.parquet(path)
    return metrics.unique_customers_by_grain(star, spark.read.parquet(path))


RECONCILED = (
    "order_id",
    "primary_payment_type",
    "max_installments",
    "gross_revenue",
    "total_payment_amount",
    "is_canceled",
)

QUERIES: dict[str, Query] = {
    "ingest_reviews": ingested_reviews,
    "ingest_row_counts": lambda spark, folder: row_counts(DriverTables(spark, folder)),
    **{name: model(name) for name in (*STAGING, "int_order_items_rolled_up", "int_payments_rolled_up", *MARTS)},
    "primary_payment_type": on_star(lambda star: rollups.primary_payment_type(star["stg_payments"])),
    "product_weight_distribution": on_star(lambda s: distribution(s, "dim_products", "weight_bucket", "products")),
    "seller_region_distribution": on_star(lambda s: distribution(s, "dim_sellers", "region", "sellers")),
    "installment_distribution": on_star(
        lambda star: star["fct_payments"]
        .groupBy("installment_bucket")
        .agg(F.count(F.lit(1)).alias("payments"), money_sum(F.col("payment_amount")).alias("payment_amount"))
    ),
    "surrogate_key": on_star(keys_of_products),
    **{name: metric(*asked) for name, asked in METRIC_QUERIES.items()},
    **{name: metric(*asked, every_period=True) for name, asked in CUMULATIVE_QUERIES.items()},
    "metric_unique_customers_by_grain": unique_customers_by_grain,
    "list_metrics": on_star(list_metrics_with_totals),
    "check_unique": on_star(lambda star: checks.unique(star.raw.file("lineitem"), "l_orderkey", "l_linenumber")),
    "check_not_null": on_star(lambda star: checks.not_null(star["stg_products"], "weight_g")),
    "check_accepted_values": on_star(
        lambda star: checks.accepted_values(
            star["stg_orders"], "order_status", [s for s in checks.ORDER_STATUSES if s != "unavailable"]
        )
    ),
    "check_relationships": on_star(orders_outside_default_calendar),
    "check_relationships_orders_without_items": on_star(
        lambda star: checks.relationships(star["stg_orders"], "order_id", star["stg_item_amounts"], "order_id")
    ),
    "assert_no_negative_revenue": on_star(
        lambda star: checks.assert_no_negative_revenue(star.order_facts(["order_id", "gross_revenue"]))
    ),
    "assert_order_revenue_matches_payments": on_star(
        lambda star: checks.assert_order_revenue_matches_payments(star.order_facts(RECONCILED))
    ),
    "stored_marts": stored_marts,
    "check_report": on_star(lambda star: checks.check_report(star.bounds.sparkSession, star)),
}

ORACLE_SQL: dict[str, str] = oracle.ORACLE | {name: oracle.metric(*asked) for name, asked in METRIC_QUERIES.items()}
