"""CSV ingest: nine files with a header, read by column name into typed raw tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.sources.csv_records import read_records
from orderlake.sources.schemas import RAW_SCHEMAS, RAW_TABLES

# Free text in reviews holds line breaks inside quotes. Only this table's records are put together
# from lines; the others' lines are their records.
MULTILINE_TABLES = frozenset({"order_reviews"})


def file_name(table: str, prefix: str = "") -> str:
    """`<prefix>orders_dataset.csv` and so on; the translation file has neither prefix nor suffix."""
    if table == "product_category_name_translation":
        return f"{table}.csv"
    return f"{prefix}{table}_dataset.csv"


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw table. Declared columns are found by name and cast; other columns stay as text.

    Text that does not fit its type fails the job rather than turning into a null.
    """
    text = spark.read.option("header", True).option("escape", '"').csv(path)
    if table in MULTILINE_TABLES:
        text = read_records(spark, path, text.columns)
    schema = RAW_SCHEMAS[table]
    absent = [name for name in schema if name not in text.columns]
    if absent:
        raise ValueError(f"{path} lacks columns {absent} of {table}")
    declared = [F.col(name).cast(kind).alias(name) for name, kind in schema.items()]
    extra = [F.col(f"`{name}`") for name in text.columns if name not in schema]
    return text.select(*declared, *extra)


def read_csv_folder(spark: SparkSession, folder: str, prefix: str = "") -> dict[str, DataFrame]:
    """All nine raw tables. Fails, naming every absent file, before any of them is processed."""
    tables, absent = {}, []
    for table in RAW_TABLES:
        path = f"{folder.rstrip('/')}/{file_name(table, prefix)}"
        try:
            tables[table] = read_csv(spark, path, table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            absent.append(path)
    if absent:
        raise FileNotFoundError(f"expected files are absent: {', '.join(absent)}")
    return tables
