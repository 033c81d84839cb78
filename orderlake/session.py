"""Session settings, and the folder for data that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable
from functools import cache, wraps
from pathlib import Path

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# What a task reads, or takes from a shuffle, on inputs of up to some terabytes.
PARTITION_BYTES = 128 * MIB

# A shuffle keeps one block per pair of map and reduce task. Beyond this many of either, tasks grow
# instead: at 100 TB each side has about this many, with 1 GiB splits.
MAX_PARTITIONS = 50_000
MAX_SPLIT_BYTES = 1024 * MIB


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Partitions to start a shuffle with; adaptive execution merges those that turn out small."""
    by_size = -(-input_bytes // PARTITION_BYTES)
    return int(min(max(by_size, cores), MAX_PARTITIONS))


def split_bytes(input_bytes: int) -> int:
    """Size of the file pieces that scans read."""
    return int(min(max(input_bytes // MAX_PARTITIONS, PARTITION_BYTES), MAX_SPLIT_BYTES))


def row_group_bytes(input_bytes: int, cores: int) -> int:
    """Size of the row groups that sinks write. A row group is read by one task, so that small tables need
    small ones for all cores to take part; without a known size it is Parquet's own."""
    return int(min(max(input_bytes // (4 * cores), 4 * MIB), PARTITION_BYTES)) if input_bytes else PARTITION_BYTES


def settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job that reads `input_bytes` with `cores` task slots."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        # A partition that fits in memory is hashed rather than sorted to join it.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(PARTITION_BYTES),
        # Files are compressed: rows in memory take some times their size. Without this a table of
        # hundreds of thousands of rows passes for small and is broadcast.
        "spark.sql.sources.fileCompressionFactor": "4",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, cores)),
        "spark.sql.files.maxPartitionBytes": str(split_bytes(input_bytes)),
        "spark.hadoop.parquet.block.size": str(row_group_bytes(input_bytes, cores)),
    }


def local_session(name: str = "orderlake", cores: int | str = 8, input_bytes: int = 0) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    slots = cores if isinstance(cores, int) else 8
    for key, value in settings(input_bytes, slots).items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording where in Python each column was made takes longer than small queries run.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset and everything runs on one machine, a folder that goes when the process ends; a
    cluster is refused, because a folder on one machine is lost with that machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return own_folder()


@cache
def own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="orderlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def with_package(query: Callable) -> Callable:
    """A query, which takes the session first, whose Python workers look for this package where the
    driver found it. On a cluster it is installed there, or sent along with --py-files."""
    place = str(Path(__file__).resolve().parent.parent)

    @wraps(query)
    def run(spark: SparkSession, *args):
        environment = spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
        if place not in paths:
            environment["PYTHONPATH"] = ":".join([place, *paths])
        return query(spark, *args)

    return run
