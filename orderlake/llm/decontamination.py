"""Benchmark passages in documents, found by an FM-index over each shard of them.

Windows. Every WINDOW consecutive words of an item are a phrase; an item of fewer words is one phrase. Words are runs of
letters, digits and characters beyond ASCII, A-Z as a-z, as 64-bit hashes.

Index. A task gathers documents to shards of bounded size. Words that no item holds end a run, and runs shorter than the
shortest phrase can't hold one; all other runs make the text that the shard's index is built over: their suffixes in order,
the words before them as a wavelet matrix, and one position in SAMPLE. All phrases are searched backward at once, a rank for
each word and end of the range; occurrences are located by walking back to a sampled position. Their words are marked, and
marked words that follow one another make a span.

Size. The items' phrases are broadcast in blocks of bounded size, and documents pass through one search after the other if
there are several blocks; nothing is shuffled.

Nulls, ties, repeated rows: null, empty and wordless texts have no words and no hits; an item without words has no window; an
item that stands in several rows is one item, with all their windows; null item identifiers are one item, listed as an empty
string. Repeated documents each get their row. A document of any length is searched whole: long runs are cut into pieces that
overlap by a window. Empty tables give empty results, an empty benchmark no hits. Other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.fm_index import FMIndex, ranges
from orderlake.llm.scratch import stored
from orderlake.llm.words import byte_set, hashed_words

WINDOW = 10
#: Words that a shard gathers before it is indexed.
SHARD_WORDS = 1 << 21
#: Words of an index at most; a longer run is cut.
INDEX_WORDS = 1 << 20
#: Words of an item that make a row, and words of all items that one search holds, on average.
PIECE_WORDS, BLOCK_WORDS = 1 << 16, 1 << 20

_IS_GAP = byte_set(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass
class Phrases:
    """Distinct windows of some items. Words are numbered from 1."""

    names: np.ndarray  # hashes of words, in order
    cells: np.ndarray  # which low bits any of them has
    windows: np.ndarray  # by window its words, at the right end
    lengths: np.ndarray
    items: list[str]
    item_bounds: np.ndarray  # by window, where its items begin and end in
    item_of: np.ndarray

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """By word its number, or 0."""
        out = np.zeros(len(hashes), np.int32)
        maybe = np.flatnonzero(self.cells[(hashes & np.uint64(len(self.cells) - 1)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.names, hashes[maybe]), len(self.names) - 1)
            out[maybe] = np.where(self.names[at] == hashes[maybe], at + 1, 0)
        return out


def phrases(items: list[str], words: list[np.ndarray], window: int = WINDOW) -> Phrases:
    """items: by piece its item; words: by piece its hashes."""
    names = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]))
    cells = np.zeros(1 << 21, bool)
    cells[(names & np.uint64(len(cells) - 1)).astype(np.int64)] = True
    named = sorted(set(items))
    number = {name: i for i, name in enumerate(named)}
    rows, of = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)]
    for item, hashes in zip(items, words, strict=True):
        if len(hashes):
            own = (np.searchsorted(names, hashes) + 1).astype(np.int32)
            own = np.concatenate([np.zeros(max(0, window - len(own)), np.int32), own])
            rows.append(np.lib.stride_tricks.sliding_window_view(own, window))
            of.append(np.full(len(rows[-1]), number[item]))
    windows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), np.concatenate(of)], 1), axis=0)
    bounds = np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1))
    return Phrases(names, cells, windows, np.count_nonzero(windows, axis=1), named, bounds, pairs[:, 1])


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The items' phrases, at least one block."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("item").to_pylist()
            for found in hashed_words(batch.column("text"), lower=True, is_gap=_IS_GAP):
                for row in range(found.first, found.last):
                    own = found.hashes[found.bounds[row - found.first] : found.bounds[row - found.first + 1]].view(np.int64)
                    parts = [own[low : low + PIECE_WORDS + window - 1] for low in range(0, max(1, len(own) - window + 1), PIECE_WORDS)]
                    yield pa.RecordBatch.from_arrays([pa.array([names[row]] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.int64()))], ["item", "part", "words"])

    pieces = stored(rows.mapInArrow(cut, "item string, part int, words array<long>"), "phrases")
    total = pieces.agg(F.sum(F.size("words"))).head()[0] or 0
    several = max(1, -(-total // block_words))
    for nth in range(several):
        own = pieces.where(F.pmod(F.xxhash64("item", "part"), F.lit(several)) == nth).toArrow()
        yield phrases(own.column("item").to_pylist(), [np.array(x, np.int64).view(np.uint64) for x in own.column("words").to_pylist()], window)


def runs(numbers: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of so many known words or more start and end; none spans two documents."""
    known = numbers > 0
    edge = np.zeros(len(numbers) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], known[:-1]]) & ~edge[:-1]
    after = np.concatenate([known[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(known & ~before), np.flatnonzero(known & ~after) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def pieces_of(starts: np.ndarray, ends: np.ndarray, overlap: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs for one index after the other; longer ones come in pieces that overlap."""
    if (ends - starts > most).any():
        cut = [(low, min(end, low + most)) for start, end in zip(starts.tolist(), ends.tolist(), strict=True) for low in range(start, max(start + 1, end - overlap), most - overlap)]
        starts, ends = np.array(cut).T
    first, total = 0, np.concatenate([[0], np.cumsum(ends - starts)])
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(total, total[first] + most, "right")) - 1)
        yield starts[first:last], ends[first:last]
        first = last


def occurrences(numbers: np.ndarray, bounds: np.ndarray, sought: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """numbers: words of a shard's documents; bounds: where each begins and the last ends. Places of windows, and which."""
    places, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(sought.windows):
        starts, ends = runs(numbers, bounds, int(sought.lengths.min()))
        for low, high in pieces_of(starts, ends, int(sought.lengths.max()) - 1, INDEX_WORDS):
            at = ranges(low, high + 1)  # each run and one place more, for the 0 that ends it
            text = np.zeros(len(at), np.int32)
            inside = np.ones(len(at), bool)
            inside[np.cumsum(high + 1 - low) - 1] = False
            text[inside] = numbers[at[inside]]
            index = FMIndex(text)
            found, first, last = index.search(sought.windows, sought.lengths)
            places.append(at[index.locate(ranges(first, last))])
            which.append(np.repeat(found, last - first))
    return np.concatenate(places), np.concatenate(which)


def _spans(starts: np.ndarray, ends: np.ndarray, words: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans of words, cut at bounds."""
    change = np.bincount(starts, minlength=words + 1) - np.bincount(ends, minlength=words + 1)
    hit = np.cumsum(change[:words]) > 0
    edge = np.zeros(words + 1, bool)
    edge[bounds] = True
    first = hit & (~np.concatenate([[False], hit[:-1]]) | edge[:-1])
    last = hit & (~np.concatenate([hit[1:], [False]]) | edge[1:])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class _Shard:
    """Documents that are searched together."""

    def __init__(self, sought: Phrases):
        self.sought, self.words = sought, 0
        self.numbers: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch, hashes: np.ndarray, bounds: np.ndarray) -> None:
        self.rows.append(rows)
        self.numbers.append(self.sought.numbers(hashes))
        self.counts.append(np.diff(bounds))
        self.words += len(hashes)

    def searched(self, keep: list[str]) -> Iterator[pa.RecordBatch]:
        numbers, counts = np.concatenate(self.numbers), np.concatenate(self.counts)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        places, which = occurrences(numbers, bounds, self.sought)
        document = np.searchsorted(bounds, places, "right") - 1
        low, high = _spans(places, places + self.sought.lengths[which], len(numbers), bounds)
        of = np.searchsorted(bounds, low, "right") - 1
        spans: list[list[tuple[int, int]]] = [[] for _ in counts]
        for doc, a, b in zip(of.tolist(), (low - bounds[of]).tolist(), (high - bounds[of]).tolist(), strict=True):
            spans[doc].append((a, b))
        items: list[set[str]] = [set() for _ in counts]
        for doc, window in np.unique(np.stack([document, which], 1), axis=0).tolist():
            items[doc].update(self.sought.items[i] for i in self.sought.item_of[self.sought.item_bounds[window] : self.sought.item_bounds[window + 1]])
        first = 0
        for batch in self.rows:
            own = slice(first, first + batch.num_rows)
            first = own.stop
            yield _with_hits(batch, keep, counts[own], items[own], spans[own])


_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_HITS = "n_words long, items array<string>, spans array<struct<first: bigint, last: bigint>>"


def _with_hits(batch: pa.RecordBatch, keep: list[str], counts: np.ndarray, items: list[set[str]], spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    """What was found is joined with what searches before this one found."""
    if "spans" in batch.schema.names:
        for i, (more, others) in enumerate(zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
            items[i] |= set(more)
            if others:
                every = np.array([*spans[i], *((x["first"], x["last"]) for x in others)])
                spans[i] = list(zip(*(x.tolist() for x in _spans(every[:, 0], every[:, 1], int(counts[i]), np.array([0]))), strict=True))
    found = [
        pa.array(counts, pa.int64()),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        pa.array([[{"first": a, "last": b} for a, b in x] for x in spans], pa.list_(_SPAN)),
    ]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *found], [*keep, "n_words", "items", "spans"])


def hits(rows: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """rows: text and others. The others, n_words, items (whose windows occur, in order), spans (of words from first to before last, none touching another)."""
    held = [rows.sparkSession.sparkContext.broadcast(sought) for sought in blocks(benchmark, item_id, item_text, window, block_words)]
    others = [c for c in rows.columns if c != "text"]
    for nth, own in enumerate(held, 1):
        keep = others if nth == len(held) else ["text", *others]

        def search(batches: Iterator[pa.RecordBatch], own=own, keep=keep) -> Iterator[pa.RecordBatch]:
            shard = _Shard(own.value)
            for batch in batches:
                for found in hashed_words(batch.column("text"), lower=True, is_gap=_IS_GAP):
                    shard.add(batch.slice(found.first, found.last - found.first), found.hashes, found.bounds)
                    if shard.words >= SHARD_WORDS:
                        yield from shard.searched(keep)
                        shard = _Shard(own.value)
            if shard.rows:
                yield from shard.searched(keep)

        kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
        rows = rows.mapInArrow(search, kinds + _HITS)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """By document: doc_id, n_words, n_hit, n_items, items, spans, contaminated."""
    found = hits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, item_id, item_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    found = found.withColumn("n_hit", n_hit)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(text: str, spans: list[dict[str, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    found = list(_WORD.finditer(text))
    parts, at = [], 0
    for span in spans:
        parts.append(text[at : found[span["first"]].start()])
        at = found[span["last"] - 1].end()
    return "".join([*parts, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All documents with all their columns, the texts without the spans found; documents without hits as they came."""
    names, at = docs.columns, docs.columns.index(text)
    rows = docs.select(F.col(text).alias("text"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column("row").flatten()
            spans = batch.column("spans").to_pylist()
            if any(spans):
                texts = columns[at].to_pylist()
                columns[at] = pa.array([without_spans(value, own) if own else value for value, own in zip(texts, spans, strict=True)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return hits(rows, benchmark, item_id, item_text).select("row", "spans").mapInArrow(cut, docs.schema)
