"""Packing: pieces by the tokenizer itself, places without gap or overlap, few sequences."""

from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderlake.llm.packing import pack_documents, packed, pieces, place, room, token_ids, vocabulary_files
from tests.llm.corpus import clashing, documents, empty, rows


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_files()[0])


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="a b1.'ßé\n\t\xa0\x85日<|>Ǆ", max_size=80), st.sampled_from(["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>\n", "<|endoftext", "it's we'll   x  ", "\r\n\r\n a"])))
def test_ids_are_the_tokenizers(text):
    t = Tokenizer.from_file(vocabulary_files()[0])
    assert token_ids(text, *vocabulary_files()) == t.encode(text, add_special_tokens=False).ids


def assert_packed(rows, capacity):
    """Pieces fill sequences from 0 on, gapless."""
    places = defaultdict(list)
    for row in rows:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_equal_and_null_ids_spread_over_groups(spark):
    """Rows that share one identifier, or have none, don't gather in one group; all are packed."""
    docs = spark.createDataFrame([(None if i % 2 else 5, "some words of one text") for i in range(4000)], "doc_id long, text string").repartition(4)
    cut = pieces(docs)
    got = packed(cut, 4000, group_pieces=100).collect()
    sizes = Counter(r.sequence_id >> 40 for r in got)
    assert sum(sizes.values()) == 4000 and len(sizes) == 40 and max(sizes.values()) < 200
    assert_packed(got, 1024)


def test_room_is_never_too_small(spark):
    docs = documents(spark)
    assert pieces(docs, length=16).count() <= room(docs, length=16)
    assert room(empty(spark)) == 0


def test_the_added_token_is_one_id():
    """As the tokenizer file has it: its string in a text is the token."""
    assert token_ids("a <|endoftext|> b", *vocabulary_files()) == [64, 220, 50256, 275]


def brute_pieces(data, tokenizer):
    out = Counter()
    for doc_id, text, *_ in data:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        low, high, nth = 0, (len(ids) - 1) % 1024 + 1, 0
        while low < len(ids):
            part = ids[low:high]
            out[doc_id, nth, low, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
            low, high, nth = high, high + 1024, nth + 1
    return out


def test_documents(spark, tokenizer):
    got = pack_documents(documents(spark)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(rows(), tokenizer)
    tokens = sum(r.length for r in got)
    assert assert_packed(got, 1024) <= -(-tokens // 1024) + 1


def test_given_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = pack_documents(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(docs.collect(), tokenizer)
    assert assert_packed(got, 1024) <= 1.01 * -(-sum(r.length for r in got) // 1024)


def test_other_columns_and_no_rows(spark):
    assert pack_documents(clashing(spark)).count() == pack_documents(documents(spark)).count()
    assert pack_documents(empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_places(lengths):
    bins, offsets = place(np.array(lengths, np.int64), 50)
    rows = [{"sequence_id": b, "offset": o, "length": n} for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths, strict=True)]
    n = assert_packed(rows, 50)
    # A sequence is opened only if no open one has room: at most one is half empty.
    assert n <= max(1, 2 * sum(lengths) // 50 + 1) or not lengths


def test_the_sum_of_squares_decides():
    """By brute force: the choice is the best of all open sequences at each step, the smaller gap among equals."""
    counts = lambda gaps: sum(v * v for v in Counter(gaps).values())
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 11, 60)
    bins, _ = place(lengths, 12)
    open_gaps: dict[int, int] = {}
    for size, chosen in zip(lengths.tolist(), bins.tolist(), strict=True):
        fits = {b: g for b, g in open_gaps.items() if g >= size}
        assert (chosen in fits) == bool(fits)
        if fits:
            after = {}
            for b in fits:
                trial = dict(open_gaps)
                trial[b] -= size
                after[b] = (counts([g for g in trial.values() if g]), fits[b])
            assert after[chosen] == min(after.values())
        open_gaps[chosen] = open_gaps.get(chosen, 12) - size
