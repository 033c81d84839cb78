"""Vectors compressed to one byte for each of PARTS parts: product quantisation by exact k-means with norm-of-sum bounds.

Components become integers, floor(SCALE * x), so that sums, means and squared distances are exact and no order of rows or tasks
matters. A part's codebook starts as that part of the vectors with the smallest identifiers. In each round every part goes to
the nearest entry, and entries move to the mean of their parts.

Bounds. Entries are dealt to GROUPS groups. For each part and group a row retains a lower bound of the distance to the group's
entries other than its own, and the round in which it was measured. The history of all codebooks tells how far each entry lies
from where it was in that round: its true net displacement, never more than the sum of its steps. Less the largest of a group,
the bound still holds; only where it doesn't exceed the exact distance to the row's own entry is the group measured again.

Size. Rows and bounds are written once a round; tasks report what entries gained and lost, as sums over the rows that moved,
and at most PARTS * ENTRIES sums reach the driver. Codebooks are the only thing that is broadcast.

Nulls, ties, repeated rows: rows whose vector is null or holds a null, an infinity or no number are left out. Vectors shorter
than the longest one, or than a multiple of PARTS, are filled up with zeros. Components too large for exact squared distances in
64 bits are limited to what fits. Of equal distances the lower entry counts; null identifiers come last, and of equal ones the
vector decides which starts the codebook; repeated rows each get their code; null labels are one label; a sum of errors that
doesn't fit is null. Fewer vectors than entries make a smaller codebook. Empty tables give empty results. Other columns may
have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.scratch import stored

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
GROUPS = 8
#: Rows that are worked on at once.
BATCH = 4096
#: What rounding may add to a root, relative to it.
SLACK = 1e-9


@dataclass(frozen=True)
class Shape:
    """What all vectors have in common."""

    width: int  # components of a part
    most: int  # the largest component, or minus the smallest
    parts: int = PARTS

    @property
    def limit(self) -> int:
        """Components up to this have squared distances that fit into 62 bits."""
        return math.isqrt((1 << 62) // self.width) // 2

    @property
    def in_floats(self) -> bool:
        """Squared distances are exact as floating-point numbers, in any order of summing."""
        return 4 * self.width * min(self.most, self.limit) ** 2 < 1 << 53

    @property
    def kind(self) -> str:
        return next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if min(self.most, self.limit) < 1 << bits)


def kept(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id, label, vector of the rows that count."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("vector"))
    return rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def shape_of(rows: DataFrame, parts: int = PARTS) -> Shape | None:
    """None without rows."""
    largest = F.array_max(F.transform("vector", F.abs))
    length, most = rows.agg(F.max(F.size("vector")), F.max(largest)).head()
    return None if length is None else Shape(max(1, -(-length // parts)), math.floor(SCALE * (most or 0.0)) + 1, parts)


def integers(vectors: pa.Array, shape: Shape) -> np.ndarray:
    """rows x parts x width."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths, n = np.diff(vectors.offsets.to_numpy()), shape.parts * shape.width
    out = np.zeros((len(vectors), n))
    out[np.arange(n) < lengths[:, None]] = vectors.flatten().to_numpy()
    with np.errstate(over="ignore"):  # what is too large is limited
        out = np.clip(np.floor(out * SCALE), -shape.limit, shape.limit)
    return out.astype(np.int64).reshape(len(vectors), shape.parts, shape.width)


def squared(points: np.ndarray, entries: np.ndarray, in_floats: bool) -> np.ndarray:
    """Squared distances of all points to all entries."""
    if not in_floats:
        return np.stack([((points - entry) ** 2).sum(1) for entry in entries], 1)
    a, b = points.astype(np.float64), entries.astype(np.float64)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)


def _root_below(x: np.ndarray) -> np.ndarray:
    """Roots, rounded towards zero."""
    return np.nextafter((np.sqrt(x.astype(np.float64)) * (1 - SLACK)).astype(np.float32), np.float32(0))


def group_bounds(entries: int, groups: int) -> np.ndarray:
    """Where each group of entries begins, and the last one ends."""
    return np.unique(np.linspace(0, entries, min(groups, entries) + 1).astype(np.int64))


@dataclass
class State:
    """Of some rows, by part: their entry; by part and group: the bound, and its round."""

    codes: np.ndarray
    lower: np.ndarray
    stamps: np.ndarray


def displacements(history: np.ndarray, part: int, cuts: np.ndarray) -> np.ndarray:
    """By round and group, how far an entry of the group lies at most from where it was then. Rounded up."""
    net = np.sqrt(((history[:-1, part] - history[-1, part]).astype(np.float64) ** 2).sum(2)) * (1 + SLACK)
    return np.maximum.reduceat(net, cuts[:-1], axis=1)


def assigned(points: np.ndarray, state: State | None, history: np.ndarray, groups: int, in_floats: bool) -> tuple[State, np.ndarray, int]:
    """points: rows x parts x width; history: rounds x parts x entries x width. State of the last round, squared distances by row and part, and how many distances were measured."""
    rows, parts, _ = points.shape
    cuts = group_bounds(history.shape[2], groups)
    n, now = len(cuts) - 1, len(history) - 1
    new = State(np.zeros((rows, parts), np.uint8), np.zeros((rows, parts, n), np.float32), np.full((rows, parts, n), now, np.uint8))
    nearest, measured = np.zeros((rows, parts), np.int64), 0
    for part in range(parts):
        x, book = points[:, part], history[now, part]
        if state is None:
            own = np.zeros(rows, np.int64)
            stale = np.ones((rows, n), bool)
            lower, stamps = new.lower[:, part], new.stamps[:, part]
        else:
            own = state.codes[:, part].astype(np.int64)
            lower, stamps = state.lower[:, part].copy(), state.stamps[:, part].copy()
            moved = displacements(history, part, cuts)
            bound = lower - moved[stamps, np.arange(n)]
        distance = ((x - book[own]) ** 2).sum(1)
        measured += rows
        if state is not None:
            stale = np.sqrt(distance.astype(np.float64))[:, None] * (1 + SLACK) >= bound
        best, at = distance.copy(), own.copy()
        found = []
        for group in range(n):
            again = np.flatnonzero(stale[:, group])
            if not len(again):
                continue
            low, high = cuts[group], cuts[group + 1]
            d = squared(x[again], book[low:high], in_floats)
            measured += d.size
            first = np.argmin(d, 1)
            least = d[np.arange(len(again)), first]
            d[np.arange(len(again)), first] = np.iinfo(np.int64).max
            found.append((group, again, first + low, least, d.min(1)))
            better = (least < best[again]) | ((least == best[again]) & (first + low < at[again]))
            best[again] = np.where(better, least, best[again])
            at[again] = np.where(better, first + low, at[again])
        if state is not None:
            # The entry that a row left counts from now on among the others of its group.
            left = np.flatnonzero(at != own)
            of = np.searchsorted(cuts, own[left], "right") - 1
            lower[left, of] = np.minimum(bound[left, of], _root_below(distance[left]))
            stamps[left, of] = now
        for group, again, first, least, second in found:
            lower[again, group] = _root_below(np.where(first == at[again], second, least))
            stamps[again, group] = now
        new.codes[:, part], new.lower[:, part], new.stamps[:, part], nearest[:, part] = at, lower, stamps, best
    return new, nearest, measured


@dataclass(frozen=True)
class Codebooks:
    """All entries, by part and entry; and the distances that were measured for them, of all that a plain search measures."""

    entries: np.ndarray
    measured: int
    plain: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _packed(x: np.ndarray) -> pa.Array:
    """A binary value for each row."""
    x = np.ascontiguousarray(x).reshape(len(x), -1)
    width = x.shape[1] * x.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())


def _unpacked(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return raw.view(kind).reshape(len(column), *shape)


_STATE = ("vector", "codes", "lower", "stamps")
_SUMS = "part int, entry int, n long, total array<long>, measured long"


def _round(rows: DataFrame, shape: Shape, history: np.ndarray, groups: int) -> DataFrame:
    """rows: kept() before the first round, then what this gives. State rows, and rows of sums, which have a part."""
    held = rows.sparkSession.sparkContext.broadcast(history)
    first = "codes" not in rows.columns
    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    names = ["vec_id", "label", *_STATE, "part", "entry", "n", "total", "measured"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        entries = books.shape[2]
        n_groups = len(group_bounds(entries, groups)) - 1
        totals, counts, measured, types = np.zeros(books.shape[1:], np.int64), np.zeros(books.shape[1:3], np.int64), 0, None
        for whole in batches:
            types = [whole.column(c).type for c in ("vec_id", "label")]
            for low in range(0, whole.num_rows, BATCH):
                batch = whole.slice(low, BATCH)
                state = None
                if first:
                    points = integers(batch.column("vector"), shape)
                else:
                    points = _unpacked(batch.column("vector"), shape.kind, shape.parts, shape.width).astype(np.int64)
                    state = State(_unpacked(batch.column("codes"), "u1", shape.parts), _unpacked(batch.column("lower"), "<f4", shape.parts, n_groups), _unpacked(batch.column("stamps"), "u1", shape.parts, n_groups))
                new, _, more = assigned(points, state, books, groups, shape.in_floats)
                measured += more
                for part in range(shape.parts):
                    moved = np.arange(len(points)) if first else np.flatnonzero(new.codes[:, part] != state.codes[:, part])
                    for codes, sign in ((new.codes, 1), *(((state.codes, -1),) if state else ())):
                        np.add.at(totals[part], codes[moved, part], sign * points[moved, part])
                        np.add.at(counts[part], codes[moved, part], sign)
                columns = [_packed(points.astype(shape.kind)), _packed(new.codes), _packed(new.lower), _packed(new.stamps)]
                none = [pa.nulls(len(points), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *columns, *none], names)
        if types:
            part, entry = np.nonzero((counts != 0) | totals.any(2) | (np.indices(counts.shape).sum(0) == 0))
            n = len(part)
            sums = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(list(totals[part, entry]), pa.list_(pa.int64())), pa.array([measured] + [0] * (n - 1), pa.int64())]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(n, t) for t in types), *(pa.nulls(n, pa.binary()) for _ in _STATE), *sums], names)

    schema = f"vec_id {kinds[0]}, label {kinds[1]}, " + "".join(f"{c} binary, " for c in _STATE) + _SUMS
    return stored(rows.mapInArrow(work, schema), "codes")


def trained(rows: DataFrame, shape: Shape, entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS) -> tuple[DataFrame, np.ndarray, Codebooks]:
    """rows: kept(). State after the last round, all codebooks in order, and the last."""
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow().column("vector")
    history = integers(start, shape).transpose(1, 0, 2)[None]
    totals, counts = np.zeros(history.shape[1:], np.int64), np.zeros(history.shape[1:3], np.int64)
    measured = vectors = 0
    state = rows
    for _ in range(rounds):
        written = _round(state, shape, history, groups)
        sums = written.where("part is not null").groupBy("part", "entry").agg(F.sum("n"), F.sum("measured"), *(F.sum(F.col("total")[i]) for i in range(shape.width))).collect()
        for part, entry, n, more, *total in sums:
            totals[part, entry] += total
            counts[part, entry] += n
            measured += more
        book = np.where(counts[..., None] > 0, totals // np.maximum(counts, 1)[..., None], history[-1])
        history = np.concatenate([history, book[None]])
        vectors += int(counts[0].sum())
        state = written.where("part is null").select("vec_id", "label", *_STATE)
    return state, history, Codebooks(history[-1], measured, vectors * shape.parts * history.shape[2])


def compressed(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS) -> tuple[DataFrame, Codebooks | None]:
    """By row that counts: vec_id, code, error, label, label_error; and the codebooks, None without rows."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's number must fit into one byte")
    rows = kept(vectors, vec_id, embedding, label)
    shape = shape_of(rows)
    if shape is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), "label", F.lit(0).cast("long").alias("label_error")), None
    state, history, books = trained(rows, shape, entries, rounds, groups)
    held = vectors.sparkSession.sparkContext.broadcast(history)
    n_groups = len(group_bounds(history.shape[2], groups)) - 1

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH):
                batch = whole.slice(low, BATCH)
                if rounds:
                    points = _unpacked(batch.column("vector"), shape.kind, shape.parts, shape.width).astype(np.int64)
                    known = State(_unpacked(batch.column("codes"), "u1", shape.parts), _unpacked(batch.column("lower"), "<f4", shape.parts, n_groups), _unpacked(batch.column("stamps"), "u1", shape.parts, n_groups))
                else:
                    points, known = integers(batch.column("vector"), shape), None
                new, nearest, _ = assigned(points, known, held.value, groups, shape.in_floats)
                codes = pa.array([x.tobytes().hex() for x in new.codes], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), codes, pa.array(nearest.sum(1)), batch.column("label")], ["vec_id", "code", "error", "label"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    found = stored(state.mapInArrow(finish, f"vec_id {kinds[0]}, code string, error long, label {kinds[1]}"), "coded")
    # Stored, so that Spark knows its size before it chooses a join.
    sums = stored(found.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "errors")
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label", "label_error"), books


def decoded(coded: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id and the approximate vector that a code stands for, in the units of the given vectors; the middle of a step of 1 / SCALE counts."""
    held = coded.sparkSession.sparkContext.broadcast(books.entries)
    rows = coded.select("vec_id", "code")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(batch.num_rows, -1)
            values = (held.value[np.arange(codes.shape[1]), codes].reshape(batch.num_rows, -1) + 0.5) / SCALE
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(values), pa.list_(pa.float64()))], ["vec_id", "vector"])

    return rows.mapInArrow(read, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, vector array<double>")
