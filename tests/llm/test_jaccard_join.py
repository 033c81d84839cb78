"""Near duplicates against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import jaccard_join
from orderlake.llm.components import connected
from orderlake.llm.jaccard_join import BAND, Frequencies, bands, most_different, links, near_duplicates, one_of_each, sketch_words, with_links
from orderlake.llm.words import mixed
from tests.llm.corpus import clashing, documents, empty, prose, rows


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def similar(a, b):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= 75 * (len(a) + len(b) - common)


def groups(data):
    """By row: its number of shingles and the smallest identifier of its component."""
    sets = [shingles(r[1]) for r in data]
    top = list(range(len(data)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                top[find(i)] = find(j)
    smallest = {}
    for i, row in enumerate(data):
        if row[0] is not None:
            smallest[find(i)] = min(row[0], smallest.get(find(i), row[0]))
    return [(r[0], len(s), smallest.get(find(i))) for i, (r, s) in enumerate(zip(data, sets, strict=True))], [find(i) for i in range(len(data))]


def near_copies(seed, copies=60):
    """A chain and a cloud of near copies, and texts that share a long passage only."""
    rng = random.Random(seed)
    out, base, passage = [], prose(rng, 150), prose(rng, 60)
    chain = list(base)
    for i in range(copies):
        chain = list(chain)
        for _ in range(3):
            chain[rng.randrange(len(chain))] = prose(rng, 1)[0]
        cloud = list(base)
        for _ in range(rng.randrange(8)):
            cloud[rng.randrange(len(cloud))] = prose(rng, 1)[0]
        apart = prose(rng, 70) + passage
        out += [(3 * i, " ".join(chain), "en", "a", 0), (3 * i + 1, " ".join(cloud), "en", "a", 0), (3 * i + 2, " ".join(apart), "en", "b", 0)]
    return out


@pytest.mark.parametrize("data", [rows(1), rows(2), near_copies(1)], ids=["odd rows", "others", "near copies"])
def test_components(spark, data):
    docs = spark.createDataFrame(data, documents(spark).schema).repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()]
    assert Counter(got) == Counter(groups(data)[0])


@pytest.mark.parametrize("data", [rows(1), near_copies(2, 20)], ids=["odd rows", "near copies"])
def test_one_of_each(spark, data):
    docs = spark.createDataFrame(data, documents(spark).schema).repartition(4)
    kept = [tuple(r) for r in one_of_each(docs).collect()]
    _, tops = groups(data)
    wordless = sum(not shingles(r[1]) for r in data)
    assert len(kept) == len({t for t, r in zip(tops, data, strict=True) if shingles(r[1])}) + wordless
    assert set(kept) <= set(data)
    for i, row in enumerate(kept):
        assert not any(similar(shingles(row[1]), shingles(other[1])) for other in kept[:i])


def test_buckets_that_hang_apart_are_compared_within(spark, monkeypatch):
    """With one word for each sketch order, buckets hold texts of different components."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 1)
    data = near_copies(3, 25)
    docs = spark.createDataFrame(data, documents(spark).schema).repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()]
    assert Counter(got) == Counter(groups(data)[0])


@pytest.mark.parametrize("chunk", [jaccard_join.CHUNK, 5])
@pytest.mark.parametrize("data", [rows(1), near_copies(1, 30)], ids=["odd rows", "near copies"])
def test_no_link_is_lost(spark, monkeypatch, data, chunk):
    """All links, and their number by document, against all pairs; also inside components."""
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    docs = spark.createDataFrame(data, documents(spark).schema).repartition(4)
    sets = [shingles(r[1]) for r in data]
    size = Counter(x for x in sets if x)
    linked = {x: [y for y in size if y != x and similar(x, y)] for x in size}
    expected = [(r[0], len(x), max(size[x] - 1, 0), sum(size[y] for y in linked.get(x, []))) for r, x in zip(data, sets, strict=True)]
    got = [(r.doc_id, r.n_shingles, r.n_copies, r.n_links) for r in with_links(docs).collect()]
    assert Counter(got) == Counter(expected) and any(r[3] for r in expected)
    smallest = {x: min((r[0] for r, y in zip(data, sets, strict=True) if x == y and r[0] is not None), default=None) for x in size}
    pairs = [tuple(sorted((smallest[x], smallest[y]), key=str)) for x in size for y in linked[x]]
    found = links(docs).collect()
    assert Counter(tuple(sorted((r.x_id, r.y_id), key=str)) for r in found for _ in range(2)) == Counter(pairs)
    assert all(r.x < r.y for r in found) and len({(r.x, r.y) for r in found}) == len(found)


def test_links_of_no_rows(spark):
    assert with_links(empty(spark)).count() == links(empty(spark)).count() == 0
    assert with_links(clashing(spark)).count() == clashing(spark).count()


def test_other_columns_and_no_rows(spark):
    docs = clashing(spark)
    assert one_of_each(docs).dtypes == docs.dtypes
    assert one_of_each(docs).count() == one_of_each(documents(spark)).count()
    assert near_duplicates(empty(spark)).count() == one_of_each(empty(spark)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10_000), st.integers(0, 10_000), st.integers(0, 1000))
def test_linked_sets_share_a_word(common, more_a, more_b, seed):
    """The pigeonhole: however two linked sets differ, each emits a word that the other does."""
    more_a, more_b = more_a % (common // 3 + 1), more_b % (common // 3 + 1)
    if 100 * common < 75 * (common + more_a + more_b):
        return
    elements = np.unique(mixed(np.arange(common + more_a + more_b, dtype=np.uint64) + np.uint64(seed << 32)))
    a, b = np.sort(elements[: common + more_a]), np.sort(np.concatenate([elements[:common], elements[common + more_a :]]))
    frequent = elements[: common // 2]
    frequencies = Frequencies(frequent, np.arange(1, len(frequent) + 1))
    emitted = [{(band, k) for band, differ in bands(len(x)) for k in sketch_words(x, band, differ + 1, frequencies).tolist()} for x in (a, b)]
    assert emitted[0] & emitted[1]


def test_bands_bound_the_difference():
    for size in range(1, 3000):
        own, *following = bands(size)
        assert BAND ** own[0] <= size < BAND ** (own[0] + 1)
        assert bool(following) == (4 * size // 3 >= BAND ** (own[0] + 1))
        assert own[1] <= most_different(size, 4 * size // 3)


def test_connected(spark):
    pairs = [(1, 2), (2, 3), (10, 11), (5, 5), *((100 + i, 101 + i) for i in range(40)), *((200, 201 + i) for i in range(50))]
    got = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "x long, y long")).collect()}
    expected = {1: 1, 2: 1, 3: 1, 10: 10, 11: 10} | {100 + i: 100 for i in range(41)} | {200 + i: 200 for i in range(51)}
    assert got == expected
    assert connected(spark.createDataFrame([], "x long, y long")).count() == 0


def test_contained_buckets_are_left_out(spark):
    """Pairs of members that share a bucket still share one."""
    rng = np.random.default_rng(5)
    rows = [(key, int(c), int(c) % 50) for key in range(60) for c in (rng.choice(40, rng.integers(2, 12), replace=False) if key % 3 else range(key % 7, key % 7 + 9))]
    members = spark.createDataFrame(rows, "key long, class long, component long")
    pairs = lambda rows: {(a, b) for k, a in rows for l, b in rows if k == l and a < b}
    kept = [(r.key, r["class"]) for r in jaccard_join._outermost(members).collect()]
    assert pairs(kept) == pairs([(k, c) for k, c, _ in rows]) and len(kept) < len(rows)


def test_long_sketches_never_lose_a_link():
    """Sets of every size: folded to equal length, the sketches' distance is at most the difference."""
    rng = np.random.default_rng(6)
    for size in (1, 2, 3, 21, 22, 85, 86, 700, 5000):
        for _ in range(20):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            b = np.concatenate([a[: size - size // 8], rng.integers(0, 1 << 63, rng.integers(0, size // 8 + 1), dtype=np.uint64)])
            common, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            near = jaccard_join._near(len(a), jaccard_join._long_sketch(a), np.array([len(b)]), jaccard_join._long_sketch(b)[None])
            assert near[0] or 100 * common < 75 * either


@pytest.mark.parametrize("chunk", [2, 512])
def test_open_buckets_are_compared_in_chunks(spark, monkeypatch, chunk):
    """Of one bucket with many members all likely pairs of different components come out, and nothing else does."""
    monkeypatch.setattr(jaccard_join, "BUCKET_CHUNK", chunk)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: 200 - 6 * (i % 9)], rng.integers(0, 1 << 63, 6 * (i % 9), dtype=np.uint64)])) for i in range(30)]
    sketches = [jaccard_join._long_sketch(x) for x in sets]
    # Two buckets; the second one is smaller and holds only pairs that the first one has.
    rows = [(key, i, i // 2, (30, 12)[key], len(x), bytearray(s.tobytes())) for key in (0, 1) for i, (x, s) in enumerate(zip(sets, sketches)) if i < (30, 12)[key]]
    members = spark.createDataFrame(rows, "key long, class long, component long, size long, n long, bits binary")
    found = [(r.x, r.y) for r in jaccard_join._apart(jaccard_join._with_largest(members)).collect()]
    got = set(found)
    assert len(found) == len(got)
    want = {(i, j) for i in range(30) for j in range(i + 1, 30) if i // 2 != j // 2 and jaccard_join._near(len(sets[i]), sketches[i], np.array([len(sets[j])]), sketches[j][None])[0]}
    assert got == want and 0 < len(want) < 400
