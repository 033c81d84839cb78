"""Benchmark passages against a plain search, and the index against sorted suffixes."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import decontamination
from orderlake.llm.decontamination import contamination, decontaminated, hits, without_spans
from orderlake.llm.fm_index import FMIndex, suffix_order
from tests.llm.corpus import SCHEMA, clashing, documents, empty, prose, rows

ITEMS = "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items):
    """By document: id, words, hit words, items."""
    windows = {}
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[k : k + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text, *_ in docs:
        own, hit, found = words(text), set(), set()
        for k in range(len(own)):
            for n in {len(w) for w in windows}:
                if k + n <= len(own) and tuple(own[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(own[k : k + n])]
        out.append((doc_id, len(own), sorted(hit), sorted(found)))
    return out


def items_for(docs, seed=3):
    """Passages of documents, some short, broken or repeated."""
    rng = random.Random(seed)
    texts = [text for _, text, *_ in docs if text and len(text.split()) > 25]
    out = []
    for i in range(12):
        own = rng.choice(texts).split()
        at = rng.randrange(len(own) - 20)
        out.append((i, " -- ".join(own[at : at + rng.choice([2, 9, 10, 14, 20])]).upper()))
    return out + [(3, " ".join(texts[0].split()[:15])), (None, " ".join(texts[1].split()[2:14])), (70, None), (71, ""), (72, "..."), (10, "nowhere " * 12)]


def found(df):
    return sorted(((r.doc_id, r.n_words, [w for s in r.spans for w in range(s["first"], s["last"])], list(r["items"])) for r in df.collect()), key=repr)


def test_as_plain_search(spark):
    items = items_for(rows())
    got = found(contamination(documents(spark), spark.createDataFrame(items, ITEMS)))
    assert got == sorted(plain(rows(), items), key=repr)
    assert sum(1 for x in got if x[2]) > 10


def test_several_blocks_and_shards(spark, monkeypatch):
    items = items_for(rows(), 5)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 4)
    docs = documents(spark).select("doc_id", "text")
    several = hits(docs, spark.createDataFrame(items, ITEMS), block_words=40)
    assert str(several._jdf.queryExecution().analyzed().toString()).count("MapInArrow") > 2
    assert found(several) == sorted(plain(rows(), items), key=repr)


@pytest.mark.parametrize(("shard", "index"), [(50, 1 << 20), (1 << 20, 37), (10, 20)])
def test_small_shards_and_cut_runs(shard, index, monkeypatch):
    """Runs longer than an index are cut with an overlap: a passage across the cut is found."""
    import pyarrow as pa

    data = rows()
    items = items_for(data, 7)
    monkeypatch.setattr(decontamination, "INDEX_WORDS", index)
    sought = decontamination.phrases(["" if i is None else str(i) for i, _ in items], [_hashes(t) for _, t in items])
    got = []
    part = decontamination._Shard(sought)
    for doc_id, text, *_ in data:
        batch = pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64())], ["doc_id"])
        own = _hashes(text)
        part.add(batch, own, np.array([0, len(own)]))
        if part.words > shard:
            got += [x for b in part.searched(["doc_id"]) for x in b.to_pylist()]
            part = decontamination._Shard(sought)
    got += [x for b in part.searched(["doc_id"]) for x in b.to_pylist()] if part.rows else []
    flat = [(x["doc_id"], x["n_words"], [w for s in x["spans"] for w in range(s["first"], s["last"])], x["items"]) for x in got]
    assert flat == plain(data, items)


def _hashes(text):
    import pyarrow as pa

    [found] = decontamination.hashed_words(pa.array([text], pa.string()), lower=True, is_gap=decontamination._IS_GAP)
    return found.hashes


def test_spans_are_cut_out(spark):
    data = [(1, "Start here. One two, three four five six seven eight nine TEN eleven! The end.", "en", "a", 5), (2, "clean text", "en", "a", 3), (3, None, None, None, None)]
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], ITEMS)
    got = {r.doc_id: r.text for r in decontaminated(spark.createDataFrame(data, SCHEMA), bench).collect()}
    assert got == {1: "Start here. ! The end.", 2: "clean text", 3: None}
    assert without_spans("a b c", [{"first": 0, "last": 1}, {"first": 2, "last": 3}]) == " b "


def test_other_columns_and_no_rows(spark):
    bench = spark.createDataFrame(items_for(rows()), ITEMS)
    docs = clashing(spark)
    assert decontaminated(docs, bench).columns == docs.columns
    assert decontaminated(docs, bench).count() == docs.count()
    assert contamination(empty(spark), bench).count() == 0
    assert contamination(documents(spark), bench.limit(0)).where("contaminated").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=30), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=5), min_size=1, max_size=10))
def test_index(parts, phrases):
    """Equal runs, periods and phrases of every length."""
    text = np.array([x for part in parts for x in [*part, 0]], np.int32)
    order = suffix_order(text)
    assert sorted(order.tolist()) == list(range(len(text)))
    cut = lambda at: text[at : at + int(np.argmax(text[at:] == 0))].tolist()
    suffixes = [cut(at) for at in order]
    assert suffixes == sorted(suffixes)
    index = FMIndex(text)
    width = max(map(len, phrases))
    padded = np.array([[0] * (width - len(p)) + p for p in phrases], np.int32)
    alive, low, high = index.search(padded, np.array([len(p) for p in phrases]))
    got = {int(a): sorted(index.locate(np.arange(b, c)).tolist()) for a, b, c in zip(alive, low, high, strict=True)}
    joined = text.tolist()
    want = {i: [k for k in range(len(joined)) if joined[k : k + len(p)] == p] for i, p in enumerate(phrases)}
    assert got == {i: places for i, places in want.items() if places}


def test_long_text(spark):
    """A document of a million words, with one passage."""
    rng = random.Random(1)
    passage = prose(rng, 12)
    long = prose(rng, 600_000) + passage + prose(rng, 400_000)
    docs = spark.createDataFrame([(1, " ".join(long), "en", "a", None)], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(passage)), (2, " ".join(prose(rng, 40)))], ITEMS)
    [row] = contamination(docs, bench).collect()
    assert (row.n_words, row.n_hit, row["items"]) == (1_000_012, 12, ["1"]) and row.spans[0]["first"] == 600_000
