"""Words, windows and counts against Python's own."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm.words import IS_FIRST, byte_counts, byte_set, hashed_words, shingle_set, window_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbBé \t\n\x0b#ſ日", max_size=60)), max_size=12)
SPACE = r"[\x20\x09-\x0D]"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_row(texts, **options):
    out = []
    for block in hashed_words(pa.array(texts, pa.string()), **options):
        out += [block.hashes[a:b] for a, b in zip(block.bounds[:-1], block.bounds[1:], strict=True)]
    return out


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_equal_words_have_equal_hashes(texts, limit):
    got = by_row(texts, lower=False, limit=limit)
    assert [len(x) for x in got] == [len(split(t)) for t in texts]
    names = {}
    for hashes, text in zip(got, texts, strict=True):
        for value, word in zip(hashes.tolist(), split(text), strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


@settings(max_examples=40, deadline=None)
@given(TEXTS)
def test_lower_case_is_ascii_only(texts):
    lowered = [None if t is None else re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in texts]
    for a, b in zip(by_row(texts, lower=True), by_row(lowered, lower=False), strict=True):
        assert a.tolist() == b.tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.integers(1, 6))
def test_windows(words, size):
    hashes = by_row([" ".join(words)], lower=False)[0]
    windows = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
    got = window_hashes(hashes, size).tolist()
    assert len(got) == len(windows)
    assert sorted(Counter(got).values()) == sorted(Counter(windows).values())
    shingles = set(windows) if len(words) >= size else {tuple(words)} if words else set()
    assert len(shingle_set(hashes, size)) == len(shingles)


@settings(max_examples=40, deadline=None)
@given(TEXTS, st.sampled_from([1, 1 << 20]))
def test_byte_counts(texts, limit):
    points, hashes = byte_counts(pa.array(texts, pa.string()), IS_FIRST, byte_set(b"#"), limit=limit)
    assert points.tolist() == [len(t or "") for t in texts]
    assert hashes.tolist() == [(t or "").count("#") for t in texts]


def test_sliced_columns_and_no_rows():
    texts = pa.array(["a b", None, "c", "d e f"]).slice(1, 3)
    assert [len(x) for x in by_row(texts.to_pylist(), lower=True)] == [0, 1, 3]
    block = next(hashed_words(texts, lower=True))
    assert np.diff(block.bounds).tolist() == [0, 1, 3]
    assert list(hashed_words(pa.array([], pa.string()), lower=True)) == []


@pytest.mark.parametrize("length", [10, 5000])
def test_a_word_longer_than_a_block(length):
    text = "x" * length + " y " + "x" * length
    a, y, b = by_row([text], lower=True, limit=100)[0]
    assert a == b != y
