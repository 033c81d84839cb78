"""A full-text index over a sequence of numbers: suffix order, wavelet ranks, sampled positions.

The sequence holds runs of symbols, each ended by 0. All searches run for many phrases or rows at once, as numpy operations.
"""

from __future__ import annotations

import numpy as np

#: Of the positions in a run each first one is kept, and one in so many.
SAMPLE = 8


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    counts = high - low
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - counts), counts)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Where each suffix starts, suffixes in order. No two zeros are equal, so that no comparison goes beyond the end of a run.

    Prefixes of doubled length are compared, and only suffixes that still have an equal one are sorted again.
    """
    n = len(text)
    order = np.argsort(text)
    inside = text[order]
    starts = np.concatenate([[True], inside[1:] != inside[:-1]])[:n] | (inside == 0)
    rank = np.empty(n, np.int64)
    first = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank[order] = first
    single = starts & np.concatenate([starts[1:], [True]])[:n]
    active, length = order[~single], 1
    while len(active):
        key = rank[active] * n + rank[active + length]
        by_key = np.argsort(key)
        active, key = active[by_key], key[by_key]
        group = rank[active]
        at = np.arange(len(active))
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        starts = np.concatenate([[True], key[1:] != key[:-1]])
        from_group = np.maximum.accumulate(np.where(new_group, at, 0))
        from_start = np.maximum.accumulate(np.where(starts, at, 0))
        rank[active] = group + (from_start - from_group)
        single = starts & np.concatenate([starts[1:], [True]])
        active, length = active[~single], 2 * length
    order[rank] = np.arange(n)
    return order


class Bits:
    """Bits, and how many are set before each place."""

    def __init__(self, bits: np.ndarray):
        whole = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        whole[: len(bits)] = bits
        self.words = np.packbits(whole, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, places: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[places >> 6] + np.bitwise_count(self.words[places >> 6] & below)


class Wavelet:
    """Ranks of symbols from 0 to symbols - 1: a level for each of their bits, the highest first."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, Bits, int]] = []  # shift, bits, zeros of the level
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = (sequence >> shift) & 1 != 0
            sequence = np.concatenate([sequence[~bits], sequence[bits]])
            self.levels.append((shift, Bits(bits), len(bits) - int(np.count_nonzero(bits))))
        self.starts = np.zeros(symbols, np.int64)  # where a symbol's places begin on the last level
        self.starts = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(places)
            places = np.where((symbols >> shift) & 1 != 0, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, places) - self.starts[symbols]

    def access(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each stands before its place."""
        symbols = np.zeros(len(places), np.int64)
        for shift, bits, zeros in self.levels:
            ones, one = bits.rank(places), bits.at(places)
            symbols |= one.astype(np.int64) << shift
            places = np.where(one, zeros + ones, places - ones)
        return symbols, places - self.starts[symbols]


class FMIndex:
    """text: numbers, runs of positive ones each ended by 0."""

    def __init__(self, text: np.ndarray):
        self.names, symbols = np.unique(text, return_inverse=True)
        symbols = symbols.astype(np.int32)
        order = suffix_order(symbols)
        self.wavelet = Wavelet(symbols[order - 1], len(self.names))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(self.names)))])
        # A walk back through a run ends at its first position at the latest, so no walk crosses a 0.
        kept = (symbols == 0) | (np.arange(len(text)) % SAMPLE == 0)
        kept[1:] |= symbols[:-1] == 0
        kept[:1] = True
        self.sampled = Bits(kept[order])
        self.positions = order[kept[order]]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """phrases: a row for each, its numbers at the right end. Phrases that occur, and their ranges of suffixes."""
        width = phrases.shape[1]
        place = np.minimum(np.searchsorted(self.names, phrases), len(self.names) - 1)
        known = self.names[place] == phrases
        used = np.arange(width) >= width - lengths[:, None]
        alive = np.flatnonzero((known | ~used).all(1) & (lengths > 0))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.before[-1])
        for step in range(1, width + 1):
            going = np.flatnonzero(lengths[alive] >= step)
            symbol = place[alive[going], width - step]
            low[going] = self.before[symbol] + self.wavelet.rank(symbol, low[going])
            high[going] = self.before[symbol] + self.wavelet.rank(symbol, high[going])
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start."""
        out, steps = np.zeros(len(rows), np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            done = self.sampled.at(rows)
            out[left[done]] = self.positions[self.sampled.rank(rows[done])] + steps
            left, rows = left[~done], rows[~done]
            symbols, rank = self.wavelet.access(rows)
            rows, steps = self.before[symbols] + rank, steps + 1
        return out
