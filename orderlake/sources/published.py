"""Full-refresh sinks that never show half a refresh.

A refresh writes its tables to a place of its own, a release, beside those that are in use. Only when all are there, one
small entry names, for each table, the release to read. Readers take the latest entry and keep to it; a refresh that fails,
at whatever point, leaves the old tables as they were. One refresh at a time may publish the same tables.

In a folder, `releases/<release>/<table>` holds rows and `published/number=<n>` the entries. In a database, a release's tables
are `<table>__<release>` and `<table>` is a view, replaced at the end.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Writes in flight at once, so that a small table does not wait for the tail of a large one.
WRITES = 4

# Keys are digests written as text, which only a codec with an entropy stage makes smaller: to about half.
CODEC = "zstd"

ENTRY = "table_name string, release string, columns string, facts string"

# Called with a written table's rows; what it gives is kept with the entry.
Facts = Mapping[str, int]


def side_by_side(write: Callable[[str], None], names: Iterable[str]) -> None:
    """Write several tables at a time; the first failure is raised once the others have ended."""
    with ThreadPoolExecutor(WRITES) as pool:
        list(pool.map(write, names))


class Release:
    """Tables being written: `save` each of them, then `publish` all."""

    def __init__(self, place: PublishedFolder | PublishedDatabase):
        self.place = place
        self.name = uuid.uuid4().hex
        self.columns: dict[str, str] = {}
        self.facts: dict[str, Facts] = {}

    def save(self, df: DataFrame, name: str, facts: Callable[[], Facts] = dict, by: str = "") -> None:
        """Write a table, in parts by a column if one is named. `facts` is asked, after the write, for what is to be known of it."""
        self.place.write(df, name, self.name, by)
        self.columns[name] = df.schema.json()
        self.facts[name] = dict(facts())

    def read(self, name: str) -> DataFrame:
        """A table of this release, which no reader sees yet."""
        return self.place.unpublished(name, self.name, StructType.fromJson(json.loads(self.columns[name])))

    def publish(self) -> None:
        self.place.publish(self)


class PublishedFolder:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def release(self) -> Release:
        return Release(self)

    def path(self, name: str, release: str) -> str:
        return f"{self.folder}/releases/{release}/{name}"

    def write(self, df: DataFrame, name: str, release: str, by: str = "") -> None:
        df.write.option("compression", CODEC).partitionBy(*[by] if by else []).parquet(self.path(name, release))

    def _entries(self) -> list:
        """The latest entry's rows; none before the first."""
        files, path = self._files("published")
        if not files.exists(path):
            return []
        found = self._all_entries()
        last = max((r.number for r in found), default="")
        return [r for r in found if r.number == last]

    def _all_entries(self) -> list:
        """One entry for each refresh, a row for each table: small however large the tables are."""
        return self.spark.read.schema(f"{ENTRY}, number string").parquet(f"{self.folder}/published").collect()

    def _files(self, name: str):
        """The file system and path of what lies in the folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def publish(self, release: Release) -> None:
        """Switch a release's tables to it; others stay where they are."""
        entries = self._entries()
        rows = {r.table_name: (r.release, r.columns, r.facts) for r in entries}
        rows |= {name: (release.name, release.columns[name], json.dumps(known)) for name, known in release.facts.items()}
        number = 1 + max((int(r.number.split("-")[0]) for r in entries), default=0)
        entry = self.spark.createDataFrame([(name, *row) for name, row in rows.items()], ENTRY)
        # One file, which appears as a whole; the name keeps two entries of one number apart.
        entry.coalesce(1).write.parquet(f"{self.folder}/published/number={number:012d}-{release.name}")

    def snapshot(self) -> Snapshot:
        entries = self._entries()
        columns = {r.table_name: StructType.fromJson(json.loads(r.columns)) for r in entries}
        return Snapshot(self, {r.table_name: r.release for r in entries}, {r.table_name: json.loads(r.facts) for r in entries}, columns)

    def table(self, name: str, release: str | None, columns: StructType | None = None) -> DataFrame:
        """A published table, or a folder of that name where none was published. Known columns spare a look into its files."""
        if not release:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(columns).parquet(self.path(name, release))

    unpublished = table

    def relation(self, name: str, release: str | None) -> str:
        """The same for a SQL statement."""
        return f"parquet.`{self.path(name, release) if release else f'{self.folder}/{name}'}`"

    def drop_old(self, keep: int = 2) -> list[str]:
        """Delete releases that none of the latest `keep` entries names; their names. Not while a refresh or a reader of an older one is at work."""
        rows = self._all_entries()
        latest = sorted({r.number for r in rows})[-keep:]
        used = {r.release for r in rows if r.number in latest}
        files, root = self._files("releases")
        gone = [s.getPath() for s in files.listStatus(root) if s.getPath().getName() not in used]
        for path in gone:
            files.delete(path, True)
        return sorted(path.getName() for path in gone)


class PublishedDatabase:
    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def release(self) -> Release:
        self.spark.sql(f"create database if not exists `{self.database}`")
        return Release(self)

    def write(self, df: DataFrame, name: str, release: str, by: str = "") -> None:
        df.write.format("parquet").option("compression", CODEC).partitionBy(*[by] if by else []).saveAsTable(f"`{self.database}`.`{name}__{release}`")

    def publish(self, release: Release) -> None:
        """Switch the views, one after the other; the tables behind them stay until `drop_old`."""
        for name, known in release.facts.items():
            if not self._is_view(name):
                self.spark.sql(f"drop table if exists {self.relation(name)}")
            comment = json.dumps(known).replace("'", "\\'")
            self.spark.sql(
                f"create or replace view {self.relation(name)} comment '{comment}' as select * from `{self.database}`.`{name}__{release.name}`"
            )

    def _is_view(self, name: str) -> bool:
        full = f"{self.database}.{name}"
        return self.spark.catalog.tableExists(full) and self.spark.catalog.getTable(full).tableType == "VIEW"

    def snapshot(self) -> Snapshot:
        if not self.spark.catalog.databaseExists(self.database):
            return Snapshot(self, {}, {})
        views = [t for t in self.spark.catalog.listTables(self.database) if t.tableType == "VIEW"]
        return Snapshot(self, {}, {t.name: json.loads(t.description or "{}") for t in views})

    def table(self, name: str, release: str | None = None, columns: StructType | None = None) -> DataFrame:
        return self.spark.table(self.relation(name))

    def unpublished(self, name: str, release: str, columns: StructType) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}__{release}`")

    def relation(self, name: str, release: str | None = None) -> str:
        return f"`{self.database}`.`{name}`"

    def drop_old(self) -> list[str]:
        """Drop the tables behind which no view stands any more; their names."""
        tables = [t.name for t in self.spark.catalog.listTables(self.database)]
        held = set()
        for name in tables:
            if self._is_view(name):
                held |= {t for t in tables if t.startswith(f"{name}__") and f"`{t}`" in self._definition(name)}
        gone = [t for t in tables if "__" in t and t not in held and not self._is_view(t)]
        for name in gone:
            self.spark.sql(f"drop table {self.relation(name)}")
        return gone

    def _definition(self, name: str) -> str:
        return self.spark.sql(f"show create table {self.relation(name)}").first()[0]


class Snapshot:
    """Published tables as one entry names them, however long they are read: `snapshot.read("fct_orders")`."""

    def __init__(
        self,
        place: PublishedFolder | PublishedDatabase,
        releases: Mapping[str, str],
        facts: Mapping[str, Facts],
        columns: Mapping[str, StructType] | None = None,
    ):
        self.place, self.releases, self.facts, self.columns = place, releases, facts, columns or {}

    def read(self, name: str) -> DataFrame:
        return self.place.table(name, self.releases.get(name), self.columns.get(name))

    def relation(self, name: str) -> str:
        return self.place.relation(name, self.releases.get(name))


DATABASE = "database:"


def published(spark: SparkSession, place: str) -> PublishedFolder | PublishedDatabase:
    """A folder or, written `database:NAME`, a database of the catalog."""
    if place.startswith(DATABASE):
        return PublishedDatabase(spark, place.removeprefix(DATABASE))
    return PublishedFolder(spark, place)
