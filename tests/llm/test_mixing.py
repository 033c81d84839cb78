"""Mixing: targets by hand, rates and reruns."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from orderlake.llm.mixing import mixed_documents, repetitions, source_targets
from tests.llm.corpus import clashing, documents, empty, rows


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Caps are dealt with one by one: what a source can't take goes to the others by weight, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        out = {s: most * sizes[s] if s in capped else weight[s] * left / free for s in order}
        above = {s for s in order if out[s] > most * sizes[s] and s not in capped}
        if not above:
            return out
        capped |= above


def test_targets(spark):
    rng = random.Random(2)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i:02}": rng.choice([0, 3, 50, 1000, 40_000]) for i in range(n)} | {None: 7, "é": 100}
        df = spark.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")
        got = {r.source: (r.source_size, r.target) for r in source_targets(df).collect()}
        expected = targets(sizes)
        for source, size in sizes.items():
            assert got[source][0] == size
            assert math.isclose(got[source][1], expected[source], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(sum(t for _, t in got.values()), 1.5 * sum(sizes.values()), rel_tol=1e-9)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = repetitions(docs).drop("row").toPandas()
    again = repetitions(docs.repartition(7)).drop("row").toPandas()
    key = ["doc_id", "copies"]
    assert Counter(map(tuple, got[key].itertuples(index=False))) == Counter(map(tuple, again[key].itertuples(index=False)))
    assert got["copies"].between(0, 2).all()
    got["taken"] = got["copies"] * got["size"]
    by_source = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"), square=("size", lambda x: (x.astype(float) ** 2).sum()))
    # Independent draws: within four standard deviations.
    assert ((by_source["taken"] - by_source["target"]).abs() <= 4 * 0.5 * by_source["square"] ** 0.5 + 1).all()
    assert got["taken"].sum() == pytest.approx(1.5 * got["size"].sum(), rel=0.03)


def test_rows(spark):
    got = repetitions(documents(spark)).collect()
    assert len(got) == len(rows())
    for row in got:
        assert row["size"] == len((row.row.text or "").split(None) if row.row.text else [])
    mix = Counter(tuple(r) for r in mixed_documents(documents(spark)).collect())
    expected = Counter()
    for row in got:
        expected[tuple(row.row)] += row.copies
    assert mix == +expected


def test_other_columns_and_no_rows(spark):
    docs = clashing(spark)
    assert mixed_documents(docs).dtypes == docs.dtypes
    assert mixed_documents(docs).count() == mixed_documents(documents(spark)).count()
    assert mixed_documents(empty(spark)).count() == repetitions(empty(spark)).count() == 0


def test_many_sources_are_joined_without_broadcast(spark):
    """Spark chooses by the size of the written table; beyond its threshold the join sorts."""
    expected = Counter((r.doc_id, r.copies) for r in repetitions(documents(spark)).collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sorted_join = repetitions(documents(spark))
        assert "BroadcastHashJoin" not in sorted_join._jdf.queryExecution().executedPlan().toString()
        assert Counter((r.doc_id, r.copies) for r in sorted_join.collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_python_runs_on_executors(spark):
    for df in (repetitions(documents(spark)), mixed_documents(documents(spark))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text
