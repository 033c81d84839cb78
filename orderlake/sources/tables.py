"""Named tables: full-refresh sinks, the way back, and the row-count audit."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_to_folder(df: DataFrame, folder: str, name: str) -> None:
    """Replace `<folder>/<name>` with the rows of df, as Parquet."""
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def read_from_folder(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


def save_to_database(df: DataFrame, database: str, name: str) -> None:
    """Replace the catalog table `<database>.<name>` with the rows of df."""
    df.sparkSession.sql(f"create database if not exists `{database}`")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")


def read_from_database(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table, in one job."""
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counts)
