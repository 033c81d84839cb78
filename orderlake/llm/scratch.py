"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from orderlake.session import shared_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to a new folder and read back: later reads don't compute them again, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
