"""Token counts kept up by deltas.

A ledger holds signed entries by document: an insert adds a count, a delete takes the known one away, a revised count does
both. Each batch writes its entries and their sums by source, language and tokenizer version; totals are the sums of all
batches. Besides, documents are dealt to buckets by a hash of their keys, and a batch writes anew what is known of the buckets
that it changes, and of no others. So a commit reads its changes and the last state of their buckets, never the history.

A batch is a set of folders of its own, the index of its buckets written last. Committing it again, after a failure or twice,
replaces it by the same rows, since it only looks at batches before it.

Nulls, ties, repeated rows: null sources and languages are groups of their own; a null count is 0; a null identifier or key is
one document; of several changes to one document in a batch, the last in order of all their columns counts; an insert of a
known document revises it, a delete of an unknown one does nothing. Empty batches change nothing. Other columns may have any
name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.packing import VOCABULARY, token_ids, vocabulary_files
from orderlake.llm.scratch import stored

GROUP = ("source", "lang", "tokenizer")
ENTRY = "key string, source string, lang string, tokenizer string, docs long, tokens long"
SUMS = "source string, lang string, tokenizer string, docs long, tokens long"
#: Deletes come before inserts and revisions, so that of both in one batch the latter counts.
DELETE, INSERT, REVISE = "delete", "insert", "revise"


#: Parts of the state, by a hash of the key.
BUCKETS = 64


class TokenRollup:
    """Rollups in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        for part, schema in (("ledger", ENTRY), ("totals", SUMS), ("index", "bucket int")):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/{part}/batch=0")
        spark.createDataFrame([], ENTRY).write.mode("ignore").parquet(f"{folder}/state/batch=0/bucket=0")

    def _read(self, part: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.folder}/{part}")

    def _known(self, batch: int, buckets: list[int]) -> DataFrame:
        """The documents of these buckets before a batch: key, source, lang, tokenizer, docs, tokens."""
        index = self._read("index", "bucket int").where((F.col("batch") < batch) & F.col("bucket").isin(buckets))
        last = {r.bucket: r.last for r in index.groupBy("bucket").agg(F.max("batch").alias("last")).collect()}
        rows = self.spark.read.schema(f"{ENTRY}, batch long, bucket int").parquet(f"{self.folder}/state")
        there = F.lit(False)
        for bucket, nth in last.items():  # conditions on partitions: other files are not read
            there |= (F.col("batch") == nth) & (F.col("bucket") == bucket)
        return rows.where(there).drop("batch", "bucket")

    def commit(self, batch: int, changes: DataFrame) -> None:
        """changes: key, op, source, lang, tokenizer, tokens. batch: a number over 0; a batch sees those of smaller numbers."""
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        bucket = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(BUCKETS)).cast("int")
        whole = F.struct((F.col("op") != DELETE).alias("adds"), "op", "tokenizer", "tokens", "source", "lang")
        last = changes.withColumn("tokens", F.coalesce("tokens", F.lit(0)).cast("long")).groupBy("key").agg(F.max(whole).alias("c")).select("key", "c.*")
        last = stored(last, "changes")
        buckets = [r.bucket for r in last.select(bucket.alias("bucket")).distinct().collect()]  # BUCKETS at most
        known = self._known(batch, buckets)
        changed = last.select(F.col("key").alias("of"))
        is_changed = F.col("key").eqNullSafe(F.col("of"))
        removed = known.join(changed, is_changed).select("key", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        added = last.where(F.col("op") != DELETE).select("key", *GROUP, F.lit(1).cast("long").alias("docs"), "tokens")
        entries = removed.union(added).groupBy("key", *GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        entries.where("docs != 0 or tokens != 0").write.mode("overwrite").parquet(f"{self.folder}/ledger/batch={batch}")
        written = self._read("ledger", ENTRY).where(F.col("batch") == batch)
        written.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{self.folder}/totals/batch={batch}")
        state = known.join(changed, is_changed, "left_anti").union(added).withColumn("bucket", bucket)
        state.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/state/batch={batch}")
        self.spark.createDataFrame([(b,) for b in buckets], "bucket int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/index/batch={batch}")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens; groups without documents are left out."""
        summed = self._read("totals", SUMS).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs != 0")


def key_of(doc_id: Column, text: Column) -> Column:
    """A document's name; one without identifier goes by its text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.sha2(F.coalesce(text, F.lit("")), 256)))


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """By document: key, source, lang, tokens of VOCABULARY."""
    rows = docs.select(key_of(F.col(doc_id), F.col(text)).alias("key"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    files = vocabulary_files(VOCABULARY)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array([len(token_ids(x.as_py(), *files)) for x in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "source", "lang")), tokens], ["key", "source", "lang", "tokens"])

    return rows.mapInArrow(count, "key string, source string, lang string, tokens long")


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """By document: key, source, lang, tokens, where white space separates tokens."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.select(key_of(F.col(doc_id), F.col(text)).alias("key"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), words.alias("tokens"))


def migrated(docs: DataFrame, folder: str) -> TokenRollup:
    """All documents inserted with their words; those of each other language deleted and inserted again, the deletion committed twice; then all revised to the tokenizer's counts."""
    rollup = TokenRollup(docs.sparkSession, folder)
    words = stored(counted_words(docs).withColumn("tokenizer", F.lit("words-1")), "words")
    rollup.commit(1, words.withColumn("op", F.lit(INSERT)))
    languages = words.groupBy("lang").agg(F.count("*").alias("n")).select("lang", (F.row_number().over(Window.orderBy(F.col("lang").asc_nulls_last())) % 2).alias("odd"))
    moved = stored(words.join(languages.where("odd = 1").select(F.col("lang").alias("of")), F.col("lang").eqNullSafe(F.col("of")), "left_semi"), "moved")
    for _ in range(2):
        rollup.commit(2, moved.withColumn("op", F.lit(DELETE)))
    rollup.commit(3, moved.withColumn("op", F.lit(INSERT)))
    revised = counted(docs).withColumns({"op": F.lit(REVISE), "tokenizer": F.lit(f"{VOCABULARY}-1")})
    rollup.commit(4, revised)
    return rollup
