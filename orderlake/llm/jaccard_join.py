"""Near duplicates by a join of parity sketches.

A document is the set of its distinct word shingles, as 64-bit hashes. Equal sets are one class, and classes are joined.

Sketches. In each band of sizes a set is dealt by hash over as many words as the band asks for; in a word the hashes are
XORed, which is a parity sketch: a word differs only where an element that one set has and the other has not falls into it. So
the number of words that differ, like the Hamming distance of a sketch's bits, is at most the symmetric difference, which for
two sets of sizes a and b is at most (a + b) / 7 at a similarity of 3/4.

Pigeonhole join. If at most d words differ, then of any two lists of d + 1 words taken by one order of all words, one word is
common. Each set emits d + 1 words, the rarest first, empty ones last: words of passages that many documents share are
emitted by few. The order comes from counts over all documents and changes the work, never the result. A pair of sizes a <= b
meets in the band of b; a set joins its own band, and the next one if a partner can lie there.

Verification. Members of a bucket are compared with its first one, and links are closed to components. Where a bucket still
spans components, its members are compared with some drawn from them, round by round while that connects many, and at last all
of different components with each other.
Of buckets with the same members one is enough, and a bucket whose members all share a larger one is contained in it: they
are left out, since what stays has all their pairs. The rest is compared inside tasks, chunk by chunk, so that only likely pairs become rows. Sizes, a short sketch and a longer one,
of some bits for each element, sort out nearly all pairs that aren't links; the others are compared set by set. So no bucket,
however large, is expanded into all pairs of a group, and no link between components is lost.

Links. All links lie inside components. For the links themselves, or their number by document, classes of a component are dealt
over chunks of bounded size, and every two chunks meet in one group of rows, where each plausible pair is compared once.

Nulls, ties, repeated rows: null, empty and blank texts have the empty set and link with nothing; a text of fewer words than a
shingle is one shingle; repeated rows are one class, null identifiers are allowed (a component takes the smallest that is not
null). Empty tables give empty results. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm.components import connected
from orderlake.llm.scratch import stored
from orderlake.llm.words import hashed_words, mixed, shingle_set

SHINGLE = 5
#: Bits of the short sketch, in 64-bit numbers.
SKETCH_LONGS = 8
#: A band holds sizes from a power of this to the next.
BAND = 4
#: Words of a band's sketches for each element of its smallest set, and at least.
SKETCH_WORDS, LEAST_WORDS = 2, 16
#: Shingles that a task counts before it reports the frequent ones, and how many it reports at most.
COUNTED, REPORTED = 4_000_000, 20_000
#: Of the reports of all tasks so many, the most frequent, make the order of words.
FREQUENT = 200_000
#: Bits of the filter by which texts are looked up: so many for each text, at least and at most. False hits cost time only.
LOOKUP_RATE, LEAST_LOOKUP_BITS, MOST_LOOKUP_BITS = 16, 1 << 20, 1 << 28
#: Bits that bitmap_construct_agg keeps together.
BITMAP_BITS = 1 << 15
#: Bits of the longer sketch for each element, at least.
LONG_RATE = 3
#: Members drawn from a bucket in a round, and the share of members below which a round's links end the rounds.
DRAWN, FEW = 4, 0.05
#: Largest buckets of a class that are named in its rows.
LARGEST = 8
#: Members of a bucket that are compared at once, on average at most.
BUCKET_CHUNK = 512

#: Classes, and shingles, that a chunk of a component holds on average at most.
CHUNK, CHUNK_SHINGLES = 256, 1_000_000

_SKETCHES = [f"s{i}" for i in range(SKETCH_LONGS)]


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """By text its shingles."""
    for words in hashed_words(texts, lower=True):
        for i in range(words.last - words.first):
            yield shingle_set(words.hashes[words.bounds[i] : words.bounds[i + 1]], SHINGLE)


def _class_of(shingles: np.ndarray) -> int:
    total = np.add.reduce(shingles, dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([total]))[0].view(np.int64))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Each shingle turns one bit."""
    bits = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % (64 * SKETCH_LONGS), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def long_bits(size: int) -> int:
    """Bits of the longer sketch of a set: a power of two."""
    return max(64, 1 << (LONG_RATE * size - 1).bit_length())


def _long_sketch(shingles: np.ndarray) -> np.ndarray:
    """Each shingle turns one bit. Halves XORed are the sketch of half the bits."""
    bits = long_bits(len(shingles))
    places = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def _halved(sketches: np.ndarray) -> np.ndarray:
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


def most_different(a: int, b: int) -> int:
    """The largest symmetric difference of two linked sets of these sizes."""
    return (a + b) // 7


def bands(size: int) -> list[tuple[int, int]]:
    """The bands in which a set looks for partners: their number, and the most that it may differ from one there."""
    own = 0
    while BAND ** (own + 1) <= size:
        own += 1
    largest = 4 * size // 3
    found = [(own, most_different(size, min(largest, BAND ** (own + 1) - 1)))]
    if largest >= BAND ** (own + 1):
        found.append((own + 1, most_different(size, largest)))
    return found


class Frequencies:
    """Counts of the frequent shingles; all others count as 0."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.counts = shingles[order], counts[order]
        self.cells = np.zeros(1 << 21, bool)
        self.cells[self._cell(shingles)] = True

    def _cell(self, shingles: np.ndarray) -> np.ndarray:
        return (shingles & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        out = np.zeros(len(shingles), np.int64)
        maybe = np.flatnonzero(self.cells[self._cell(shingles)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.shingles, shingles[maybe]), len(self.shingles) - 1)
            out[maybe] = np.where(self.shingles[at] == shingles[maybe], self.counts[at], 0)
        return out


def sketch_words(shingles: np.ndarray, band: int, emitted: int, frequencies: Frequencies) -> np.ndarray:
    """Keys of the rarest words of the set's sketch in this band, so many."""
    words = max(LEAST_WORDS, SKETCH_WORDS * BAND**band)
    often = frequencies.of(shingles)
    # By its leading bits, so that shingles, which are in order, come word by word.
    word = ((shingles >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    value = np.bitwise_xor.reduceat(shingles, starts)
    keys = _keys(value, word[starts], band)
    if len(keys) > emitted:
        # A word is at most as frequent as its rarest shingle.
        often = np.minimum.reduceat(often, starts)
        rare = keys[often == 0]
        if len(rare) >= emitted:
            return np.partition(rare, emitted - 1)[:emitted]
        return keys[np.lexsort((keys, often))[:emitted]]
    empty = np.setdiff1d(np.arange(words, dtype=np.uint64), word)[: emitted - len(keys)]
    return np.concatenate([keys, _keys(np.zeros(len(empty), np.uint64), empty, band)])


def _keys(value: np.ndarray, word: np.ndarray, band: int) -> np.ndarray:
    """One number for a word's place and value; an empty word has the value 0."""
    return mixed(value + mixed(word * np.uint64(256) + np.uint64(band)))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _profiles(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """A row for each document: doc_id, text_hash, n, class, sketch; and rows of frequent shingles with their counts."""
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), _text_hash(text).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "n", "class", *_SKETCHES, "shingle", "often"]

    def report(gathered: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        shingles, often = np.unique(np.concatenate(gathered), return_counts=True)
        top = np.flatnonzero(often > 2)
        if len(top) > REPORTED:
            top = top[np.argpartition(-often[top], REPORTED)[:REPORTED]]
        return shingles[top].view(np.int64), often[top]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, total, id_type = [], 0, None
        none = lambda n, kind=None: pa.nulls(n, kind or pa.int64())

        def reported() -> pa.RecordBatch:
            shingles, often = report(gathered)
            n = len(shingles)
            return pa.RecordBatch.from_arrays([none(n, id_type), *(none(n) for _ in names[1:-2]), pa.array(shingles), pa.array(often)], names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            n, classes, sketches = [], [], []
            for shingles in _sets(batch.column("text")):
                n.append(len(shingles))
                classes.append(_class_of(shingles) if len(shingles) else None)
                sketches.append(_sketch(shingles))
                gathered.append(shingles)
                total += len(shingles)
                if total >= COUNTED:
                    yield reported()
                    gathered.clear()
                    total = 0
            sketch = np.array(sketches, np.int64).reshape(len(n), SKETCH_LONGS)
            arrays = [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(classes, pa.int64()), *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_LONGS))]
            yield pa.RecordBatch.from_arrays([*arrays, none(len(n)), none(len(n))], names)
        if gathered:
            yield reported()

    schema = f"doc_id {kind}, " + ", ".join(f"`{name}` long" for name in names[1:])
    return rows.mapInArrow(profile, schema)


def _buckets(docs: DataFrame, text: Column, frequencies: Frequencies) -> DataFrame:
    """Rows (key, first, class): members of a bucket besides its first one, each once."""
    held = docs.sparkSession.sparkContext.broadcast(frequencies)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # spares copies that this task has emitted already
        for batch in batches:
            keys, classes, waiting = [], [], 0
            for shingles in _sets(batch.column("text")):
                name = _class_of(shingles) if len(shingles) else None
                if name is None or name in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(name)
                for band, differ in bands(len(shingles)):
                    keys.append(sketch_words(shingles, band, differ + 1, held.value).view(np.int64))
                    classes.append(np.full(len(keys[-1]), name, np.int64))
                    waiting += len(keys[-1])
                if waiting > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(classes))], ["key", "class"])
                    keys, classes, waiting = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(classes))], ["key", "class"])

    emitted = docs.select(text.alias("text")).mapInArrow(emit, "key long, class long")
    bucket = Window.partitionBy("key").orderBy("class")
    # Running minima and the row before: no window holds a bucket.
    first = F.min("class").over(bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.lag("class").over(bucket)
    marked = emitted.select("key", first.alias("first"), before.alias("before"), "class")
    return marked.where((F.col("class") != F.col("first")) & (F.col("class") != F.col("before"))).select("key", "first", "class")


def _rows_at(rows: DataFrame, hashes: DataFrame, inside: bool) -> DataFrame:
    """Rows whose text_hash may be (inside), or is surely not, among the hashes; which rows may be there, a filter tells whose size follows the number of hashes. Beyond MOST_LOOKUP_BITS it passes more rows and grows no larger."""
    wanted = LOOKUP_RATE * hashes.count()
    size = min(max(1 << max(0, wanted - 1).bit_length(), LEAST_LOOKUP_BITS), MOST_LOOKUP_BITS)
    cell = F.pmod("text_hash", F.lit(size))
    maps = hashes.groupBy(F.floor(cell / BITMAP_BITS).cast("int").alias("part")).agg(F.bitmap_construct_agg(cell % BITMAP_BITS).alias("bits")).toArrow()
    packed = np.zeros((size // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for part, bits in zip(maps.column("part").to_pylist(), maps.column("bits").to_pylist(), strict=True):
        packed[part] = np.frombuffer(bits, np.uint8)
    packed = packed.reshape(-1)
    held = rows.sparkSession.sparkContext.broadcast(packed if inside else ~packed)
    at = rows.columns.index("text_hash")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(at).to_numpy() % size
            yield batch.filter(pa.array((held.value[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 != 0))

    return rows.mapInArrow(find, rows.schema)


def _candidate_texts(docs: DataFrame, text: Column, wanted: DataFrame) -> DataFrame:
    """class, text for the wanted classes and the text_hash of a text of each. One copy of each text is shuffled, once."""
    rows = docs.select(_text_hash(text).alias("text_hash"), text.alias("text"))
    found = _rows_at(rows, wanted, inside=True).groupBy("text_hash").agg(F.first("text").alias("text"))
    return found.join(wanted, "text_hash").select("class", "text")


def _plausible(x: str, y: str) -> Column:
    """Sizes and bit sketches allow a link."""
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    distance = sum((F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _SKETCHES[1:]), F.bit_count(F.col(f"{x}.s0").bitwiseXOR(F.col(f"{y}.s0"))))
    return (4 * F.least(a, b) >= 3 * F.greatest(a, b)) & (7 * distance <= a + b)


def _sketches(texts: DataFrame) -> DataFrame:
    """class, n and the longer sketch of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bits = [], []
            for shingles in _sets(batch.column("text")):
                n.append(len(shingles))
                bits.append(_long_sketch(shingles).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(n, pa.int64()), pa.array(bits, pa.binary())], ["class", "n", "bits"])

    return stored(texts.mapInArrow(work, "class long, n long, bits binary"), "sketches")


def _near(a: int, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which sets of sizes b and sketches y, all of the same bits, may be linked with the set of size a and sketch x."""
    while x.shape[-1] > y.shape[-1]:
        x = _halved(x)
    while y.shape[-1] > x.shape[-1]:
        y = _halved(y)
    distance = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return (4 * np.minimum(a, b) >= 3 * np.maximum(a, b)) & (7 * distance <= a + b)


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those pairs x, y that the longer sketches allow."""
    end = lambda c: sketches.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.join(end("x"), "x").join(end("y"), "y").select("x", "y", "n_x", "n_y", "bits_x", "bits_y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column("n_x").to_pylist(), batch.column("n_y").to_pylist(), strict=True)
            bits = zip(batch.column("bits_x"), batch.column("bits_y"), strict=True)
            read = lambda value: np.frombuffer(value.as_buffer(), np.uint64)
            keep = [bool(_near(a, read(x), np.array([b]), read(y)[None])[0]) for (a, b), (x, y) in zip(sizes, bits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(work, "x long, y long")


def _linked(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those pairs x, y whose sets are similar."""
    pairs = _likely(pairs, sketches)
    both = pairs.join(texts.select(F.col("class").alias("x"), F.col("text").alias("text_x")), "x")
    both = both.join(texts.select(F.col("class").alias("y"), F.col("text").alias("text_y")), "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                similar = []
                for a, b in zip(_sets(batch.column("text_x")), _sets(batch.column("text_y")), strict=True):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    similar.append(100 * common >= 75 * (len(a) + len(b) - common))
                yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], ["x", "y"]).filter(pa.array(similar, pa.bool_()))

    return both.select("x", "y", "text_x", "text_y").mapInArrow(verify, "x long, y long")


def _with_component(rows: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    joined = rows.join(labels.select(F.col("node").alias("_node"), F.col("component").alias("_of")), F.col(column) == F.col("_node"), "left")
    return joined.withColumn(name, F.coalesce("_of", column)).drop("_node", "_of")


def _class_links(docs: DataFrame, text: Column, classes: DataFrame, frequencies: Frequencies) -> tuple[DataFrame, DataFrame]:
    """A text of each class that may have a link, and the components that links make; of these enough are found to connect all that hangs together."""
    buckets = stored(_buckets(docs, text, frequencies), "buckets")
    wanted = buckets.select("class").union(buckets.select(F.col("first").alias("class"))).distinct()
    wanted = stored(wanted.join(classes.select("class", "text_hash"), "class"), "wanted")
    texts = stored(_candidate_texts(docs, text, wanted), "texts")
    known = classes.select("class", "n", *_SKETCHES)

    sketches = _sketches(texts)

    # Every member with the first one of its buckets: that connects most groups.
    stars = buckets.select(F.col("first").alias("x"), F.col("class").alias("y")).distinct()
    stars = stars.join(known.alias("a"), F.col("x") == F.col("a.class")).join(known.alias("b"), F.col("y") == F.col("b.class"))
    links = stored(_linked(stars.where(_plausible("a", "b")).select("x", "y"), texts, sketches), "links")
    labels = connected(links)
    # What is left: members of one bucket, other than its first, in different components. They are compared with some drawn
    # from them, which gathers what hangs together, until that connects few; then all that are still apart with each other.
    members = _open_members(buckets.select("key", "class"), known, labels)
    for nth in count():
        members = _outermost(members)
        draws = F.array(*(F.min_by("class", F.xxhash64("class", F.lit(DRAWN * nth + i))) for i in range(DRAWN)))
        drawn = members.groupBy(F.col("key").alias("of")).agg(draws.alias("chosen")).select("of", F.explode(F.array_distinct("chosen")).alias("chosen"))
        chosen = members.join(drawn, (F.col("key") == F.col("of")) & (F.col("class") == F.col("chosen"))).drop("of", "chosen")
        more = stored(_linked(_met(chosen, members), texts, sketches), "links")
        found = more.count()
        if found:
            links = links.union(more)
            labels = connected(links)
            apart = members.select("class").distinct().count()
            members = _open_members(members.select("key", "class"), known, labels)
        if not found or found < FEW * apart:
            break
    members = _outermost(members).select("key", "class", "component", "size")
    more = stored(_linked(_apart(_with_largest(members).join(sketches, "class")).distinct(), texts, sketches), "links")
    if not more.isEmpty():
        links = links.union(more)
        labels = connected(links)
    return texts, labels


def _outermost(members: DataFrame) -> DataFrame:
    """members: key, class and others. One of all buckets with the same members, and no bucket whose members all have one and the same larger bucket: the ones that stay hold all pairs."""
    names = F.bit_xor(F.xxhash64("class")), F.bit_xor(F.xxhash64("class", F.lit(1)))
    members = members.drop("size")
    sizes = stored(members.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("size"), *(name.alias(f"name{i}") for i, name in enumerate(names))), "sizes")
    firsts = sizes.groupBy("size", "name0", "name1").agg(F.min("of").alias("of")).select("of", "size")
    sized = stored(members.join(firsts, F.col("key") == F.col("of")).drop("of"), "sized")
    largest = sized.groupBy(F.col("class").alias("named")).agg(F.max(F.struct("size", "key"))["key"].alias("largest"))
    spans = F.min("largest").alias("low"), F.max("largest").alias("high")
    holders = sized.join(largest, F.col("class") == F.col("named")).groupBy(F.col("key").alias("of")).agg(*spans)
    outer = holders.where((F.col("low") != F.col("high")) | (F.col("low") == F.col("of"))).select("of")
    return stored(sized.join(outer, F.col("key") == F.col("of")).drop("of"), "outermost")


def _with_largest(members: DataFrame) -> DataFrame:
    """members: key, class, size and others. With sizes and keys of the class's largest buckets, LARGEST at most."""
    own = members.groupBy(F.col("class").alias("named")).agg(F.slice(F.sort_array(F.collect_list(F.struct("size", "key")), False), 1, LARGEST).alias("largest"))
    largest = own.select("named", F.col("largest.size").alias("sizes"), F.col("largest.key").alias("keys"))
    return members.join(largest, F.col("class") == F.col("named")).drop("named")


def _apart(members: DataFrame) -> DataFrame:
    """members: key, class, component, size (of the bucket), n, bits, sizes and keys of larger buckets. Likely pairs x < y of a bucket in different components, compared chunk by chunk; a pair comes in the largest bucket that it shares, and in smaller ones only if that is not among those named."""
    chunks = F.ceil(F.col("size") / BUCKET_CHUNK)
    dealt = members.withColumn("chunk", F.pmod(F.xxhash64("class"), chunks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    group = F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    dealt = dealt.select("key", *group, "size", "chunk", "class", "component", "n", "bits", "sizes", "keys").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def pairs_of(group: tuple, rows: list[tuple]) -> Iterator[np.ndarray]:
        chunk, classes, components, n = (np.array([row[i] for row in rows], np.int64) for i in range(4))
        words = np.array([len(row[4]) // 8 for row in rows])
        key, low, high = group
        own_rank = (rows[0][7], key)
        larger = [{k for size, k in zip(row[5], row[6], strict=True) if (size, k) > own_rank} for row in rows]
        by_words = {w: np.flatnonzero(words == w) for w in np.unique(words).tolist()}
        sketches = {w: np.frombuffer(b"".join(rows[i][4] for i in at), np.uint64).reshape(len(at), w) for w, at in by_words.items()}
        for at in np.flatnonzero(chunk == low).tolist():
            own = np.frombuffer(rows[at][4], np.uint64)
            for w, others in by_words.items():
                if max(w, words[at]) > 2 * min(w, words[at]):
                    continue  # sizes that far apart aren't similar
                there = (chunk[others] == high) & (components[others] != components[at])
                if low == high:
                    there &= others > at
                found = np.flatnonzero(there)
                found = others[found[_near(int(n[at]), own, n[others[found]], sketches[w][found])]]
                found = np.array([i for i in found.tolist() if larger[at].isdisjoint(larger[i])], np.int64)
                if len(found):
                    yield np.stack([np.minimum(classes[at], classes[found]), np.maximum(classes[at], classes[found])])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _grouped(batches, ("key", "low", "high"), ("chunk", "class", "component", "n", "bits", "sizes", "keys", "size")):
            for x, y in pairs_of(group, rows) if len(rows) > 1 else ():
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    return dealt.mapInArrow(work, "x long, y long")


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow one another with equal keys."""
    group, rows = None, []
    for batch in batches:
        names = zip(*(batch.column(c).to_pylist() for c in keys), strict=True)
        for key, row in zip(names, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if key != group:
                if rows:
                    yield group, rows
                group, rows = key, []
            rows.append(row)
    if rows:
        yield group, rows


def _open_members(members: DataFrame, known: DataFrame, labels: DataFrame) -> DataFrame:
    """Of members key, class those in buckets that span several components, with component and what is known of the class."""
    members = _with_component(members, "class", labels, "component")
    spans = F.min("component").alias("low"), F.max("component").alias("high")
    several = members.groupBy("key").agg(*spans).where("low != high").select("key")
    return stored(members.join(several, "key").join(known, "class"), "members")


def _met(some: DataFrame, members: DataFrame) -> DataFrame:
    """Plausible pairs x < y of two members of a bucket in different components, the one among some, each pair once."""
    a, b = some.alias("a"), members.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component")) & _plausible("a", "b"))
    pair = F.least("a.class", "b.class").alias("x"), F.greatest("a.class", "b.class").alias("y")
    return met.select(*pair).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """By document: doc_id, n_shingles, component_id, class (null for the empty set), class_id (smallest doc_id of the class), text_hash, component."""
    return _near_duplicates(docs, doc_id, text)[0]


def _near_duplicates(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What near_duplicates gives; by class: class, class_id, size (its documents); by class that has links: class, component, size, n, text."""
    profiles = stored(_profiles(docs, F.col(doc_id), F.col(text)), "profiles")
    often = profiles.where("shingle is not null").groupBy("shingle").agg(F.sum("often").alias("often"))
    top = often.orderBy(F.desc("often"), "shingle").limit(FREQUENT).toArrow()
    frequencies = Frequencies(top.column("shingle").to_numpy().view(np.uint64), top.column("often").to_numpy())
    documents = profiles.where("shingle is null")
    same = [F.min(c).alias(c) for c in ("text_hash", "n", *_SKETCHES)]
    classes = stored(documents.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size"), *same), "classes")
    texts, labels = _class_links(docs, F.col(text), classes, frequencies)
    placed = _with_component(classes.select("class", "class_id"), "class", labels, "component")
    smallest = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    decided = stored(placed.join(smallest, "component").select("class", "class_id", "component", "component_id"), "components")
    joined = documents.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("class").alias("own"))
    joined = joined.join(decided, F.col("own") == F.col("class"), "left")
    alone = F.col("own").isNull()
    found = joined.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("own").alias("class"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "text_hash",
        "component",
    )
    members = labels.withColumnRenamed("node", "class").join(classes.select("class", "size", "n"), "class").join(texts, "class")
    return found, classes.select("class", "class_id", "size"), members


def _chunk_pairs(members: DataFrame) -> DataFrame:
    """Rows of members for each two chunks of a component, and each chunk with itself: (component, low, high), chunk, class, size, text; rows of one group follow one another."""
    sized = members.groupBy(F.col("component").alias("of")).agg(F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).alias("chunks"))
    dealt = members.join(sized, F.col("component") == F.col("of")).withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    group = F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    return dealt.select("component", *group, "chunk", "class", "size", "text").repartition("component", "low", "high").sortWithinPartitions("component", "low", "high")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By group of two chunks that has links: classes and sizes of its rows, and the linked rows' numbers."""
    group, rows = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("component", "low", "high")), strict=True)
        rest = zip(*(batch.column(c).to_pylist() for c in ("chunk", "class", "size")), strict=True)
        for key, row, shingles in zip(keys, rest, _sets(batch.column("text")), strict=True):
            if key != group:
                if len(rows) > 1:
                    yield _links_in_group(group, rows)
                group, rows = key, []
            rows.append((*row, shingles))
    if len(rows) > 1:
        yield _links_in_group(group, rows)


def _links_in_group(group: tuple, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    chunk, classes, sizes = (np.array([row[i] for row in rows], np.int64) for i in range(3))
    sets = [row[3] for row in rows]
    n = np.array([len(x) for x in sets], np.int64)
    sketches = np.array([_sketch(x) for x in sets]).view(np.uint64)
    distinct, places = np.unique(np.concatenate(sets), return_inverse=True)
    places = np.split(places, np.cumsum(n)[:-1])
    marked = np.zeros(len(distinct), bool)
    _, low, high = group
    of_low, of_high = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, a in enumerate(of_low):
        others = of_high[at + 1 :] if low == high else of_high
        both = n[a] + n[others]
        distance = np.bitwise_count(sketches[others] ^ sketches[a]).sum(1, dtype=np.int64)
        plausible = (4 * np.minimum(n[a], n[others]) >= 3 * np.maximum(n[a], n[others])) & (7 * distance <= both)
        others, both = others[plausible], both[plausible]
        marked[places[a]] = True
        common = np.array([np.count_nonzero(marked[places[b]]) for b in others], np.int64)
        marked[places[a]] = False
        others = others[100 * common >= 75 * (both - common)]
        first.append(np.full(len(others), a))
        second.append(others)
    return classes, sizes, np.concatenate(first), np.concatenate(second)


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every two classes whose sets are similar, each pair once: x, y (the classes, x < y), x_id, y_id (their smallest doc_id)."""
    _, classes, members = _near_duplicates(docs, doc_id, text)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for named, _, first, second in _groups(batches):
            a, b = named[first], named[second]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["x", "y"])

    found = _chunk_pairs(members).mapInArrow(pairs, "x long, y long")
    for end in ("x", "y"):
        found = found.join(classes.select(F.col("class").alias(end), F.col("class_id").alias(f"{end}_id")), end)
    return found.select("x", "y", "x_id", "y_id")


def with_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """By document what near_duplicates gives, and n_copies, the other documents of its class, and n_links, the documents of other classes that are similar to it.

    Links are counted where they are found: no pair of a group of near copies becomes a row.
    """
    found, classes, members = _near_duplicates(docs, doc_id, text)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for named, sizes, first, second in _groups(batches):
            linked = np.zeros(len(named), np.int64)
            np.add.at(linked, first, sizes[second])
            np.add.at(linked, second, sizes[first])
            yield pa.RecordBatch.from_arrays([pa.array(named), pa.array(linked)], ["linked_class", "linked"])

    counted = _chunk_pairs(members).mapInArrow(counted, "linked_class long, linked long").groupBy("linked_class").agg(F.sum("linked").alias("linked"))
    by_class = classes.select(F.col("class").alias("of_class"), "size").join(counted, F.col("of_class") == F.col("linked_class"), "left")
    joined = found.join(by_class, F.col("class") == F.col("of_class"), "left")
    return joined.select(*found.columns, F.coalesce(F.col("size") - 1, F.lit(0)).alias("n_copies"), F.coalesce("linked", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one of each component, with all their columns as they came: the one with the smallest identifier, null last; of rows that share it, any one. Documents without words all stay.

    Only rows that have another one in their component, and a few that the filter can't tell from them, are shuffled.
    """
    found = stored(near_duplicates(docs, doc_id, text).where("component is not null"), "near")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    groups = found.groupBy("component").agg(F.min(order).alias("m"), F.count("*").alias("rows"))
    groups = stored(groups.select("component", "rows", F.col("m.doc_id").alias("chosen_id"), F.col("m.text_hash").alias("chosen_hash")), "groups")
    contested = found.join(groups.where("rows > 1").select("component"), "component").select("text_hash")

    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(whole.alias("row"), F.col(doc_id).alias("id"), _text_hash(F.col(text)).alias("text_hash"))
    maybe = _rows_at(rows, contested, inside=True)
    others = _rows_at(rows, contested, inside=False)
    chosen = groups.select("chosen_id", "chosen_hash")
    kept = maybe.join(chosen, F.col("text_hash").eqNullSafe(F.col("chosen_hash")) & F.col("id").eqNullSafe(F.col("chosen_id")))
    nth = F.row_number().over(Window.partitionBy("text_hash", "id").orderBy(F.lit(0)))
    kept = kept.withColumn("nth", nth).where("nth = 1").select("row.*")
    wordless = F.coalesce(F.col(f"row.`{text}`"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
    # A row without words has no component; where the filter takes it for another, it comes back by itself.
    return others.select("row.*").union(kept).union(maybe.where(wordless).select("row.*"))
