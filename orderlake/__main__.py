"""Command line: `spark-submit` or `python -m orderlake <command>`.

    ingest  --files DIR --raw PLACE [--prefix P]   CSV files to raw tables, with row counts
    build   --raw PLACE --marts PLACE [--staging DATABASE] [--start D --end D] [--by-month]
    check   --raw PLACE --marts PLACE              all data checks; exit code 1 on an error
    query   --marts PLACE --metrics a,b [--group-by x,y] [--every-period] [--since D] [--until D] [--out DIR]
    list                                           metrics and dimensions

A place is a folder or, written `database:NAME`, a database of the catalog. A query's whole result goes
to the folder named by --out, as Parquet, or else to the screen. `--input-gib N --cores M` sizes
partitions for the data and the cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from orderlake.operators import checks, metrics
from orderlake.operators.dimensions import END_DATE, START_DATE, date_range
from orderlake.plans.build import Stored, build, create_views, facts_of, refresh, save_raw
from orderlake.plans.staging_views import create_staging
from orderlake.plans.star import Star
from orderlake.session import MIB, settings
from orderlake.sources.published import published
from orderlake.sources.schemas import RAW_TABLES
from orderlake.sources.tables import row_counts


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderlake", description="Commerce analytics on Spark")
    commands = parser.add_subparsers(dest="command", required=True)
    folders = {
        "ingest": ("--files", "--raw"),
        "build": ("--raw", "--marts"),
        "check": ("--raw", "--marts"),
        "query": ("--marts",),
        "list": (),
    }
    for command, options in folders.items():
        sub = commands.add_parser(command)
        sub.add_argument("--input-gib", type=int, default=0, help="size of all inputs")
        sub.add_argument("--cores", type=int, default=8, help="task slots of the cluster")
        for option in options:
            sub.add_argument(option, required=True, metavar="DIR" if option == "--files" else "PLACE")
        if command == "ingest":
            sub.add_argument("--prefix", default="", help="what file names begin with")
        if command in ("build", "check"):
            sub.add_argument("--start", default=START_DATE, help="first day of the calendar")
            sub.add_argument("--end", default=END_DATE, help="day after its last")
        if command == "query":
            sub.add_argument("--metrics", required=True)
            sub.add_argument("--group-by", default="")
            sub.add_argument("--every-period", action="store_true", help="running totals for all periods")
            sub.add_argument("--since", metavar="D", help="first day that counts")
            sub.add_argument("--until", metavar="D", help="day after the last that counts")
            sub.add_argument("--out", metavar="DIR", help="folder for the result")
        if command == "build":
            sub.add_argument("--by-month", action="store_true", help="store facts in a part for each month")
            sub.add_argument("--staging", metavar="DATABASE", help="database for views of the staging models")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    asked = arguments(argv)
    builder = SparkSession.builder.appName("orderlake")
    for key, value in settings(asked.input_gib * 1024 * MIB, asked.cores).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()

    if asked.command == "ingest":
        raw = refresh(published(spark, asked.raw), lambda save: save_raw(spark, asked.files, save, asked.prefix))
        row_counts({name: raw.read(name) for name in RAW_TABLES}).show(truncate=False)
        return 0
    if asked.command == "list":
        metrics.list_metrics(spark).show(len(metrics.METRICS), truncate=False)
        dimensions = metrics.list_dimensions(spark)
        dimensions.show(dimensions.count(), truncate=False)
        return 0
    if asked.command == "query":
        names, groups = asked.metrics.split(","), [g for g in asked.group_by.split(",") if g]
        marts = published(spark, asked.marts).snapshot()
        result = metrics.metric_query(Stored(marts.read), names, groups, asked.every_period, asked.since, asked.until)
        if groups:
            result = result.orderBy(*groups)
        if asked.out:
            result.write.mode("overwrite").parquet(asked.out)
            return 0
        print(*result.columns, sep="\t")
        for row in result.toLocalIterator():
            print(*row, sep="\t")
        return 0

    raw, place = published(spark, asked.raw).snapshot(), published(spark, asked.marts)
    star = Star({name: raw.read(name) for name in RAW_TABLES}, date_range(spark, asked.start, asked.end))
    if asked.command == "build":
        create_views(star)
        if asked.staging:
            create_staging(spark, asked.staging, raw.relation)
        refresh(place, lambda save: build(star, save), asked.by_month)
        return 0
    marts = place.snapshot()
    report = checks.stored_report(spark, Stored(marts.read, star), facts=facts_of(raw, marts))
    report.filter("status <> 'pass'").show(len(checks.CHECKS), truncate=False)
    counts = {row.status: row.checks for row in checks.status_counts(report).collect()}
    print(" ".join(f"{status.upper()}={counts.get(status, 0)}" for status in ("pass", "warn", "error")))
    return 1 if counts.get("error") else 0


if __name__ == "__main__":
    sys.exit(main())
