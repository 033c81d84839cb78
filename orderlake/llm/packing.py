"""Packing documents into training sequences by sums of squares.

Every document is tokenised, ended by a separator, and cut into pieces only where it is longer than a sequence. Pieces are
dealt into groups of GROUP_PIECES at most, on average, by a hash of the row's number, so that no identifier gathers them, and each group is packed for itself: the next piece goes where the
sum, over all gaps, of the squared number of open sequences with that gap becomes smallest; among equals into the smallest gap
that fits. A sequence is opened only if the piece fits into no open one, and pieces go in order of length, longest first: both
give fewer sequences. A group's work and memory are bounded whatever the input.

Nulls, ties, repeated rows: a null or empty text is the separator alone; null identifiers are allowed; repeated rows are
packed each for itself, with equal doc_id. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 1024
SEPARATOR = 2
#: Pieces that a group has room for. More pieces pack a little tighter and take longer in one task.
GROUP_PIECES = 80_000
VOCABULARY = "byte_bpe_50k"

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"

#: Outside these characters the two libraries that know the vocabulary could split a text differently.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")


@lru_cache
def _encoders(vocabulary: str, tokenizer_file: str, rank_file: str):
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer_file)
    added = tuple(token.content for token in exact.get_added_tokens_decoder().values())
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return exact, added, tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str | None, tokenizer_file: str, rank_file: str) -> list[int]:
    """The ids of the tokenizer file. For plain texts without its added tokens they come from the same vocabulary in a faster library."""
    exact, added, fast = _encoders(VOCABULARY, tokenizer_file, rank_file)
    if not text:
        return []
    if _PLAIN.fullmatch(text) and not any(token in text for token in added):
        return fast.encode_ordinary(text)
    return exact.encode(text, add_special_tokens=False).ids


def vocabulary_files(vocabulary: str = VOCABULARY) -> tuple[str, str]:
    return public_tokenizers.path(f"{vocabulary}.json"), public_tokenizers.path(f"{vocabulary}.tiktoken")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, separator: int = SEPARATOR, files: tuple[str, str] | None = None) -> DataFrame:
    """Every document's pieces, with the checksum of their ids."""
    files = files or vocabulary_files()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, piece, start, size, crc = [], [], [], [], []
            for row, value in enumerate(batch.column("text")):
                ids = np.array([*token_ids(value.as_py(), *files), separator], "<u4")
                low, high, nth = 0, (len(ids) - 1) % length + 1, 0
                while low < len(ids):
                    rows.append(row)
                    piece.append(nth)
                    start.append(low)
                    size.append(high - low)
                    crc.append(zlib.crc32(ids[low:high].tobytes()))
                    low, high, nth = high, high + length, nth + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; pieces are taken in the given order."""
    open_with = [[] for _ in range(capacity + 1)]  # by gap: open sequences
    counts = np.zeros(capacity + 1, np.int64)  # by gap; a gap of 0 counts nothing
    filled: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        change = 2 * (counts[: capacity + 1 - size] - counts[size:]) + 2  # by gap, from size on
        change[0] = 1 - 2 * counts[size]
        change[counts[size:] == 0] = np.iinfo(np.int64).max
        gap = int(np.argmin(change)) + size
        if counts[gap]:
            chosen = open_with[gap].pop()
            counts[gap] -= 1
        else:
            gap, chosen = capacity, len(filled)
            filled.append(0)
        bins[i], offsets[i] = chosen, filled[chosen]
        filled[chosen] += size
        if gap > size:
            open_with[gap - size].append(chosen)
            counts[gap - size] += 1
    return bins, offsets


def room(docs: DataFrame, text: str = "text", length: int = LENGTH) -> int:
    """A number of pieces that the documents never exceed: one for each, and one for each `length` bytes, since no token is shorter than a byte."""
    whole = F.coalesce(F.floor(F.octet_length(F.col(text)) / length), F.lit(0))
    return docs.agg(F.sum(whole + 1)).head()[0] or 0


def packed(cut: DataFrame, pieces: int, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """cut: rows of pieces(). With sequence_id and offset of each. pieces: how many there are at most."""
    groups = max(1, -(-pieces // group_pieces))
    number = F.monotonically_increasing_id()
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", number), F.lit(groups)))

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = place(rows.column("length").to_numpy(), length)
        ids = (rows.column("group").to_numpy().astype(np.int64) << 40) + bins
        return rows.drop_columns("group").append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("group").applyInArrow(fill, PIECES.format(id=cut.schema["doc_id"].dataType.simpleString()) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All documents as pieces with their places."""
    return packed(pieces(docs, doc_id, text, length), room(docs, text, length), length)
