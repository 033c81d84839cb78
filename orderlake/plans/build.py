"""Runs that write tables: ingest of raw files, and the build of the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.calendar import period_start
from orderlake.operators.checks import counters
from orderlake.plans.star import MARTS, STAGING, Star
from orderlake.sources.csv_files import read_csv_folder
from orderlake.sources.published import PublishedDatabase, PublishedFolder, Release, Snapshot, side_by_side
from orderlake.sources.schemas import RAW_TABLES
from orderlake.sources.tables import row_counts

# A sink: called with rows and a table name, it replaces that table and gives back what it wrote, if it can.
Save = Callable[[DataFrame, str], DataFrame | None]
# The way back: called with a table name.
Read = Callable[[str], DataFrame]

# Fixed value: the load stamp, put on dimensions and facts when they are written.
LOADED_AT = "dbt_loaded_at"
STAMPED = ("dim_customers", "dim_products", "dim_sellers", "fct_orders", "fct_order_items", "fct_payments")


# The month of a row's day, by which a large fact can be stored: fact -> its day.
MONTH = "order_month"
DATED = {name: "order_date_key" for name in ("fct_orders", "fct_order_items", "fct_payments")}


def checked_sink(release: Release, by_month: bool = False) -> Save:
    """Saves tables to a release; what breaks rules that single rows tell is counted in the same pass.

    With `by_month`, facts are stored in a part for each month. Their rows are brought together by
    month before, so that a month makes few files; adaptive execution splits one that is too large.
    """

    def save(df: DataFrame, name: str) -> DataFrame:
        seen, by = Observation(), ""
        if by_month and name in DATED:
            by = MONTH
            df = df.withColumn(MONTH, period_start(F.col(DATED[name]), "month")).hint("rebalance", MONTH)
        release.save(df.observe(seen, *counters(name)), name, lambda: seen.get, by)
        return release.read(name)

    return save


def refresh(place: PublishedFolder | PublishedDatabase, write: Callable[[Save], None], by_month: bool = False) -> Snapshot:
    """Run `write` with a sink for a new release; publish what it saved if it does not fail."""
    release = place.release()
    write(checked_sink(release, by_month))
    release.publish()
    return place.snapshot()


def facts_of(*snapshots: Snapshot) -> dict[str, dict[str, int]]:
    """What was counted of published tables while they were written."""
    return {name: dict(known) for s in snapshots for name, known in s.facts.items() if known}


def save_raw(spark: SparkSession, folder: str, save: Save, prefix: str = "") -> None:
    """Replace all raw tables with the files of a folder."""
    raw = read_csv_folder(spark, folder, prefix)
    side_by_side(lambda name: save(raw[name], name), raw)


def ingest(spark: SparkSession, folder: str, save: Save, read: Read, prefix: str = "") -> DataFrame:
    """Replace all raw tables with the files of a folder; the result counts the stored rows."""
    save_raw(spark, folder, save, prefix)
    return row_counts({name: read(name) for name in RAW_TABLES})


def create_views(star: Star, names: Iterable[str] = STAGING) -> None:
    """Staging models as temporary views of this session."""
    for name in names:
        star[name].createOrReplaceTempView(name)


def build(star: Star, save: Save, names: Iterable[str] = MARTS) -> None:
    """Replace the marts, side by side. Orders come after payments, whose table they read where both are written."""
    written: dict[str, DataFrame | None] = {}

    def write(name: str) -> None:
        payments = written.get("fct_payments") if name == "fct_orders" else None
        df = star[name] if payments is None else star.orders_beside(payments)
        written[name] = save(df.withColumn(LOADED_AT, F.current_timestamp()) if name in STAMPED else df, name)

    names = list(names)
    if {"fct_orders", "fct_payments"} <= {*names}:
        side_by_side(write, ["fct_payments", *(n for n in names if n not in ("fct_orders", "fct_payments"))])
        names = ["fct_orders"]
    side_by_side(write, names)


class Stored:
    """Built marts, read back, for metrics and checks: `stored["fct_orders"]`.

    Tables that are not marts come from `star`.
    """

    def __init__(self, read: Read, star: Star | None = None):
        self.read = read
        self.star = star
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MARTS and self.star is not None:
            return self.star[name]
        if name not in self._read:
            self._read[name] = self.read(name)
        return self._read[name]

    def order_facts(self, columns: Iterable[str], since: str | None = None, until: str | None = None) -> DataFrame:
        """Of facts stored by month, only the parts with days from `since` up to, but without, `until`."""
        facts = self["fct_orders"]
        if MONTH in facts.columns:
            if since:
                facts = facts.filter(F.col(MONTH) >= period_start(F.lit(since).cast("date"), "month"))
            if until:
                facts = facts.filter(F.col(MONTH) < F.lit(until).cast("date"))
        return facts.select(*dict.fromkeys(columns))
