"""Rollups against counts made anew."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlake.llm.packing import vocabulary_files
from orderlake.llm.queries import op5_token_rollup
from orderlake.llm.token_rollup import TokenRollup, counted, counted_words, migrated
from tests.llm.corpus import clashing, documents, empty, rows

CHANGE = "key string, op string, source string, lang string, tokenizer string, tokens long"


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


def summed(state):
    docs, tokens = Counter(), Counter()
    for source, lang, tokenizer, n in state.values():
        docs[source, lang, tokenizer] += 1
        tokens[source, lang, tokenizer] += n
    return {k: (docs[k], tokens[k]) for k in docs}


def test_random_batches(spark, tmp_path):
    rng = random.Random(5)
    rollup, state = TokenRollup(spark, str(tmp_path)), {}
    for batch in range(1, 5):
        changes = []
        for key in rng.sample([*map(str, range(30)), None], 12):
            op = rng.choice(["insert", "revise", "delete"])
            row = (rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]), rng.choice([0, 5, 70]))
            changes.append((key, op, *row))
            if op == "delete":
                state.pop(key, None)
            else:
                state[key] = row
        df = spark.createDataFrame(changes, CHANGE)
        rollup.commit(batch, df)
        assert totals(rollup) == summed(state)
        if batch % 2:  # after a failure, or by mistake
            rollup.commit(batch, df)
            assert totals(rollup) == summed(state)
    assert totals(TokenRollup(spark, str(tmp_path))) == summed(state)


def test_several_changes_and_odd_ones(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path))
    rollup.commit(1, spark.createDataFrame([("x", "insert", "a", "en", "v1", None), ("x", "insert", "a", "en", "v1", None), ("y", "delete", "a", "en", "v1", 4)], CHANGE))
    assert totals(rollup) == {("a", "en", "v1"): (1, 0)}
    rollup.commit(2, spark.createDataFrame([("x", "delete", None, None, None, None), ("x", "revise", "b", "de", "v1", 9)], CHANGE))
    assert totals(rollup) == {("b", "de", "v1"): (1, 9)}
    rollup.commit(3, spark.createDataFrame([], CHANGE))
    rollup.commit(4, spark.createDataFrame([("x", "delete", None, None, None, None)], CHANGE))
    assert totals(rollup) == {}


def distinct_documents(data):
    """By name, the words, and the tokens of a document; of rows that repeat a name, the one that counts."""
    tokenizer = Tokenizer.from_file(vocabulary_files()[0])
    out = {}
    for doc_id, text, lang, source, _ in data:
        name = doc_id if doc_id is not None else text or ""
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        order = lambda x: (x[2], x[0] is not None, x[0] or "", x[1] is not None, x[1] or "")
        row = (source, lang, n)
        out[name] = max(out.get(name, row), row, key=order)
    return {k: (source, lang, "byte_bpe_50k-1", n) for k, (source, lang, n) in out.items()}


def test_documents(spark, tmp_path):
    assert totals(migrated(documents(spark), str(tmp_path / "a"))) == summed(distinct_documents(rows()))
    assert totals(migrated(clashing(spark), str(tmp_path / "b"))) == summed(distinct_documents(rows()))
    assert totals(migrated(empty(spark), str(tmp_path / "c"))) == {}
    assert counted(documents(spark)).count() == counted_words(documents(spark)).count() == len(rows())


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    data = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in op5_token_rollup(spark, folder).collect()}
    assert got == summed(distinct_documents(data))


def test_a_commit_reads_and_writes_only_the_buckets_it_changes(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path))
    rollup.commit(1, spark.createDataFrame([(str(i), "insert", "a", "en", "v1", 1) for i in range(500)], CHANGE))
    rollup.commit(2, spark.createDataFrame([("7", "revise", "b", "en", "v1", 3), (None, "insert", "b", "en", "v1", 1)], CHANGE))
    folders = lambda batch: sorted(p.name for p in (tmp_path / "state" / f"batch={batch}").glob("bucket=*"))
    assert len(folders(1)) == 64 and len(folders(2)) <= 2
    buckets = [int(x.removeprefix("bucket=")) for x in folders(2)]
    known = rollup._known(3, buckets)
    files = known.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("/state/batch=2/" in r.f for r in files)
    assert "PartitionFilters: [" in known._jdf.queryExecution().executedPlan().toString()
    assert rollup._known(3, buckets).where("key = '7'").first().tokens == 3
    assert totals(rollup) == {("a", "en", "v1"): (499, 499), ("b", "en", "v1"): (2, 4)}


def test_a_batch_that_failed_half_way_is_replaced(spark, tmp_path):
    """Its state is written but its index isn't: later batches don't see it until it is committed again."""
    rollup = TokenRollup(spark, str(tmp_path))
    rollup.commit(1, spark.createDataFrame([("x", "insert", "a", "en", "v1", 1)], CHANGE))
    change = spark.createDataFrame([("x", "revise", "a", "en", "v1", 5)], CHANGE)
    rollup.commit(2, change)
    spark.createDataFrame([], "bucket int").write.mode("overwrite").parquet(f"{tmp_path}/index/batch=2")
    rollup.commit(2, change)
    rollup.commit(3, spark.createDataFrame([("x", "revise", "a", "en", "v1", 7)], CHANGE))
    assert totals(rollup) == {("a", "en", "v1"): (1, 7)}
