"""The registered queries against their SQL, and the pipeline."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from orderlake.llm.oracle import ORACLE_SQL
from orderlake.llm.queries import QUERIES
from tests.compare import assert_same
from tests.llm.test_jaccard_join import shingles, similar

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, FOLDER), duck, ORACLE_SQL[name])


def test_names():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline(spark):
    """Each stage keeps the columns of documents, and what it drops has a reason."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    after = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, FOLDER)
        assert rows.columns == docs.columns
        rows = spark.createDataFrame(rows.collect(), docs.schema)
        after[name] = [tuple(r) for r in rows.collect()]
    given = {tuple(r) for r in docs.collect()}
    assert all(set(kept) <= given for kept in after.values())
    scores = {r.doc_id: r.predicted for r in QUERIES["op10_toxicity"](spark, FOLDER).collect()}
    assert {r[0] for r in after["toxicity"]} == {r[0] for r in given if not scores[r[0]]}
    texts = [" ".join(r[1].split()) for r in after["exact_dedup"]]
    assert len(set(texts)) == len(texts) == len({" ".join(r[1].split()) for r in after["toxicity"]})
    sets = [shingles(r[1]) for r in after["near_dedup"]]
    assert not any(similar(a, b) for i, a in enumerate(sets) for b in sets[:i])
    taken = Counter(r[0] for r in after["mixing"])
    assert max(taken.values()) <= 2 and set(taken) <= {r[0] for r in after["near_dedup"]}
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == taken


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
