"""Codes against a plain k-means over integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import vector_codes
from orderlake.llm.vector_codes import PARTS, Shape, assigned, compressed, decoded, squared

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries=256, rounds=4):
    """vec_id, code, error, label_error by row, and the codebooks' hash."""
    good = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return [], None
    width = -(-max(len(v) for _, v, _ in good) // PARTS) or 1
    good = [(i, [*v, *[0] * (PARTS * width - len(v))], label) for i, v, label in good]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(good, key=lambda x: (x[0] is None, x[0] or 0, x[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(PARTS)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(PARTS):
            members = [[] for _ in books[p]]
            for _, v, _ in good:
                members[nearest(v, p)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(members, books[p])]
    found = [(i, [nearest(v, p) for p in range(PARTS)], label) for i, v, label in good]
    errors = {}
    for _, near, label in found:
        errors[label] = errors.get(label, 0) + sum(d for d, _ in near)
    digest = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    return sorted(((i, bytes(e for _, e in near).hex(), sum(d for d, _ in near), errors[label]) for i, near, label in found), key=repr), digest


def vectors(seed=1, n=150, dims=8):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        middle = rng.choice(middles)
        v = [float(np.float32(x + rng.gauss(0, 0.2))) for x in middle]
        rows.append((i * 3, v, rng.choice([1, 2, None])))
    odd = [(1, None, 1), (2, [0.5] * (dims - 1) + [None], 1), (4, [float("nan")] * dims, 2), (5, [float("inf")] * dims, None), (7, [-0.0] * dims, 2)]
    return rows + odd + rows[:5] + [(None, [0.25] * dims, 3), (None, [0.125] * dims, 3), (rows[0][0], [0.75] * dims, 1)]


def got(df, books):
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in df.collect()), key=repr), books.sha256() if books else None


@pytest.mark.parametrize(("entries", "groups"), [(256, 8), (16, 8), (16, 1), (5, 3), (1, 4)])
def test_as_plain_search(spark, entries, groups):
    df = spark.createDataFrame(vectors(), SCHEMA).repartition(4)
    coded, books = compressed(df, entries=entries, groups=groups)
    assert got(coded, books) == plain(vectors(), entries)


def test_odd_lengths_and_large_values(spark):
    """Shorter vectors are filled up; components of any size are taken exactly as long as their squares fit."""
    rows = [(i, [float(x) for x in range(i % 4)], 1) for i in range(20)] + [(50, [], 1)]
    assert got(*compressed(spark.createDataFrame(rows, SCHEMA), entries=4)) == plain(rows, 4)
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.uniform(-2e5, 2e5))) for _ in range(9)], i % 2) for i in range(60)]
    assert got(*compressed(spark.createDataFrame(rows, SCHEMA), entries=7)) == plain(rows, 7)
    coded, _ = compressed(spark.createDataFrame([*rows, (99, [3e38, -3e38, 1.0], 1)], SCHEMA), entries=7)
    assert coded.count() == 61


def test_no_rows_and_other_columns(spark):
    df = spark.createDataFrame(vectors(), SCHEMA)
    assert compressed(df.limit(0))[0].count() == 0 and compressed(df.where("embedding is null"))[1] is None
    more = df.selectExpr("*", *(f"map('{c}', 1) as `{c}`" for c in ("vector", "codes", "part", "n", "of", "code", "error", "label_error")))
    assert got(*compressed(more, entries=16)) == got(*compressed(df, entries=16))


def test_bounds_save_work(spark):
    """On the given vectors fewer distances are measured than a plain search measures."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    coded, books = compressed(df)
    assert books.measured < 0.8 * books.plain
    rows = {r.vec_id: np.array(r.embedding) for r in df.collect()}
    errors = {r.vec_id: r.error for r in coded.collect()}
    for r in decoded(coded, books).collect():
        assert abs(np.sum((np.array(r.vector) - rows[r.vec_id]) ** 2) * 1024**2 - errors[r.vec_id]) < 0.1 * errors[r.vec_id] + 100


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 30), st.integers(1, 12), st.integers(1, 5), st.sampled_from([3, 40, 2000]), st.booleans())
def test_bounds_never_change_the_result(seed, rows, entries, groups, reach, in_floats):
    """Any moves of the codebooks, ties included: the nearest entry, the lower of equal ones."""
    rng = np.random.default_rng(seed)
    points = rng.integers(-reach, reach, (rows, PARTS, 2))
    history = rng.integers(-reach, reach, (1, PARTS, entries, 2))
    state = None
    for _ in range(5):
        state, nearest, _ = assigned(points, state, history, groups, in_floats)
        for part in range(PARTS):
            d = squared(points[:, part], history[-1, part], False)
            assert (state.codes[:, part] == d.argmin(1)).all() and (nearest[:, part] == d.min(1)).all()
        step = rng.integers(-reach // 3 - 1, reach // 3 + 2, history[-1].shape) * (rng.random((PARTS, entries, 1)) < 0.5)
        history = np.concatenate([history, (history[-1] + step)[None]])


def test_exact_in_floats():
    shape = Shape(16, 1 << 22)
    assert shape.in_floats and not Shape(16, 1 << 24).in_floats and vector_codes.Shape(16, 40_000).kind == "<i4"
