"""Dimensions: dates, customers, products, sellers, and the daily time spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions import buckets
from orderlake.functions.calendar import day_of_week, period_start
from orderlake.functions.keys import surrogate_key

# The default calendar. The end is not part of it.
START_DATE = "2016-01-01"
END_DATE = "2019-01-01"


def date_range(spark: SparkSession, start: str = START_DATE, end: str = END_DATE) -> DataFrame:
    """One row (start_date, end_date) from two ISO dates."""
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date")
    )


def years_covering(df: DataFrame, moment: str) -> DataFrame:
    """One row (start_date, end_date): the whole years that hold every value of `moment`."""
    last_year = F.date_trunc("year", F.max(moment)).cast("date")
    return df.agg(
        F.date_trunc("year", F.min(moment)).cast("date").alias("start_date"),
        F.add_months(last_year, 12).alias("end_date"),
    )


def dim_dates(bounds: DataFrame) -> DataFrame:
    """One row per day from start_date up to, but without, end_date."""
    whole = F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("date_key")
    days = bounds.select("end_date", whole).filter("date_key < end_date")
    day = F.col("date_key")
    parts = {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "iso_week": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": day_of_week(day),
        "day_of_year": F.dayofyear(day),
    }
    return days.select(
        day,
        day.cast("timestamp_ntz").alias("full_date"),
        *(part.cast("bigint").alias(name) for name, part in parts.items()),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        day_of_week(day).isin(0, 6).alias("is_weekend"),
        *(period_start(day, grain).alias(f"{grain}_start") for grain in ("week", "month", "quarter", "year")),
    )


def time_spine(dates: DataFrame) -> DataFrame:
    return dates.select(F.col("date_key").alias("date_day"))


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per person. Zip, city and state are each the greatest on record, so an address may
    be put together from several."""
    people = customers.groupBy("customer_unique_id").agg(
        F.max("zip_code_prefix").alias("zip_code_prefix"),
        F.max("city").alias("city"),
        F.max("state").alias("state"),
        F.count_distinct("customer_id").alias("order_account_count"),
    )
    return people.select(surrogate_key("customer_unique_id").alias("customer_key"), "*")


def volume() -> Column:
    """Length × height × width; null if one of them is."""
    return (F.col("length_cm") * F.col("height_cm") * F.col("width_cm")).cast("decimal(30,6)")


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "category_name",
        "category_name_pt",
        buckets.weight_bucket(F.col("weight_g")).alias("weight_bucket"),
        "weight_g",
        "length_cm",
        "height_cm",
        "width_cm",
        volume().alias("volume_cm3"),
        "photos_qty",
        "name_length",
        "description_length",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id",
        "zip_code_prefix",
        "city",
        "state",
        buckets.region(F.col("state")).alias("region"),
    )
