"""Words of Arrow string columns as 64-bit hashes, found with numpy over the column's bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: White space that separates words.
SPACES = b" \t\n\x0b\x0c\r"
#: So many bytes are worked on at once; a longer text is cut at white space.
BLOCK_BYTES = 1 << 17

_SEED = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_SEED.integers(1, 1 << 63)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_set(members: bytes) -> np.ndarray:
    """A table of 256 booleans."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


IS_SPACE = byte_set(SPACES)
#: First bytes of code points.
IS_FIRST = byte_set(bytes(x for x in range(256) if not 0x80 <= x < 0xC0))
#: Values of bytes where A-Z count as a-z.
_LOWERED_VALUES = _BYTE_VALUES.copy()
_LOWERED_VALUES[65:91] = _BYTE_VALUES[97:123]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int, kept: dict = {}) -> np.ndarray:  # noqa: B006 computed once in each process
    if len(kept.get(base, ())) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        kept[base] = np.cumprod(steps, dtype=np.uint64)
    return kept[base][:n]


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each starts and the last ends; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)), bounds


def blocks(bounds: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes, or of one row."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, last
        first = last


def _pieces(data: np.ndarray, low: int, high: int, is_gap: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cuts the bytes from low to high after white space, into pieces of about `limit` bytes; only a longer word makes a longer piece."""
    while high - low > limit:
        end = low + limit
        while end < high:
            gaps = np.flatnonzero(is_gap[data[end : min(high, end + limit)]])
            if len(gaps):
                end += int(gaps[0]) + 1
                break
            end = min(high, end + limit)
        yield low, end
        low = end
    yield low, high


@dataclass
class Words:
    """Words of the rows from `first` to `last`."""

    first: int
    last: int
    hashes: np.ndarray
    bounds: np.ndarray  # words of row first + i: from bounds[i] to bounds[i + 1]
    part: np.ndarray | None  # for each word, the number of breaks before it in the block
    stems: list[np.ndarray]  # for each length asked for, hashes of the words' first bytes; 0 for words that aren't longer


def hashed_words(texts: pa.Array, lower: bool, is_gap: np.ndarray = IS_SPACE, is_break: np.ndarray | None = None, stem_bytes: tuple[int, ...] = (), limit: int = BLOCK_BYTES) -> Iterator[Words]:
    """The words of every text, block by block. A word is a run of bytes that aren't gaps; lower: A-Z count as a-z."""
    data, bounds = text_bytes(texts)
    for first, last in blocks(bounds, limit):
        found, starts, parts, before = [], [], [], 0
        stems: list[list[np.ndarray]] = [[] for _ in stem_bytes]
        for low, high in _pieces(data, int(bounds[first]), int(bounds[last]), is_gap, limit) if last == first + 1 else [(int(bounds[first]), int(bounds[last]))]:
            if low == high:
                continue
            raw = data[low:high]
            inside = ~is_gap[raw]
            edge = np.zeros(high - low + 1, bool)  # a text starts here
            edge[bounds[first : last + 1][(bounds[first : last + 1] >= low) & (bounds[first : last + 1] <= high)] - low] = True
            starts_word = inside.copy()
            starts_word[1:] &= ~inside[:-1] | edge[1:-1]
            ends_word = inside.copy()
            ends_word[:-1] &= ~inside[1:] | edge[1:-1]
            start, end = np.flatnonzero(starts_word), np.flatnonzero(ends_word) + 1
            sums = np.zeros(high - low + 1, np.uint64)
            values = (_LOWERED_VALUES if lower else _BYTE_VALUES)[raw]
            values *= _powers(_BASE, high - low)
            np.cumsum(values, out=sums[1:])
            back = _powers(_INVERSE, high - low)[start]
            found.append(mixed((sums[end] - sums[start]) * back + (end - start).astype(np.uint64)))
            for size, own in zip(stem_bytes, stems, strict=True):
                cut = np.minimum(start + size, end)
                own.append(np.where(cut < end, mixed((sums[cut] - sums[start]) * back + np.uint64(size << 32)), np.uint64(0)))
            starts.append(start + low)
            if is_break is not None:
                total = np.cumsum(is_break[raw] | edge[:-1])
                parts.append(total[start] + before)
                before += int(total[-1])
        hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        part = None if is_break is None else np.concatenate(parts) if parts else np.zeros(0, np.int64)
        yield Words(first, last, hashes, np.searchsorted(at, bounds[first : last + 1]), part, [np.concatenate(own) if own else hashes for own in stems])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of so many words; the order of words counts."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mixed(total)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct windows, in order of their hashes; with fewer words, the whole sequence is the one window."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(size, len(words))))


def byte_counts(texts: pa.Array, *tables: np.ndarray, limit: int = BLOCK_BYTES) -> list[np.ndarray]:
    """For each table, how many bytes of every text are in it."""
    data, bounds = text_bytes(texts)
    out = [np.zeros(len(bounds) - 1, np.int64) for _ in tables]
    for first, last in blocks(bounds, limit):
        own = bounds[first : last + 1]
        for low in range(int(own[0]), int(own[-1]), 4 * limit):  # one turn, but for a very long text
            high = min(int(own[-1]), low + 4 * limit)
            edges = np.clip(own, low, high) - low
            for counts, table in zip(out, tables, strict=True):
                sums = np.concatenate([[0], np.cumsum(table[data[low:high]])])
                counts[first:last] += sums[edges[1:]] - sums[edges[:-1]]
    return out
