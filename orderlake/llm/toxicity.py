"""Toxicity by multiple-instance learning.

Labels say which documents are toxic, not which sentences. A sentence's score grows with the weights of its words and of
their stems; a document is toxic if any sentence is: scores combine by noisy-or. Words that toxic documents of a bounded
sample of labelled rows hold significantly more often (documents by word are counted in Spark) get weights, fitted to the
documents' labels by gradient on the driver, which sees only the places of these words; a sentence
that scores next to nothing counts as nothing, so that long clean documents stay clean. Scoring gives each document its
score, and each sentence its own, which locates the offending ones.

Nulls, ties, repeated rows: null and empty texts score 0; a null identifier is never held out and has no label; of several
labels of one document the greatest counts; repeated rows get equal scores. Without labels of both kinds all scores are 0.
Empty tables give empty results. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.scratch import stored
from orderlake.llm.words import byte_set, hashed_words

#: Labelled documents that the fit reads at most, of each label.
SAMPLE_DOCS = 2500
#: Bytes of their texts, of each label, at most; of those with the smallest hashes the ones that fit come first.
SAMPLE_BYTES = 32 << 20
FEATURES = 1 << 18
#: A document is toxic from this score on.
TOXIC = 0.3
#: A sentence without evidence has a score of e to this power, which is then taken off.
BIAS = -5.0
#: Sentences that score less count as 0.
LEAST_SCORE = 0.02
ROUNDS = 200
RATE = 0.1
L2 = 0.5
#: A word gets a weight if it occurs in so many of the sample's documents, and if the difference of its shares in toxic and in
#: clean ones is so many standard errors.
LEAST_DOCS = 2
LEAST_ERRORS = 4.0
#: Stems of so many bytes count besides whole words.
STEM_BYTES = (4, 5, 6, 7, 8)

_LETTERS = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)])
_IS_GAP = ~byte_set(_LETTERS)
_IS_BREAK = byte_set(b".!?\n")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Sentences:
    """Words and stems of sentences of some documents. sentence: by word; document: by sentence, rising."""

    word: np.ndarray
    sentence: np.ndarray
    document: np.ndarray


def sentences(texts: pa.Array) -> Iterator[tuple[int, int, Sentences]]:
    """Block by block: first and last row, and their sentences."""
    for words in hashed_words(texts, lower=True, is_gap=_IS_GAP, is_break=_IS_BREAK, stem_bytes=STEM_BYTES):
        rows = np.repeat(np.arange(words.last - words.first), np.diff(words.bounds))
        # The starts of texts count as breaks, so that a part never spans two.
        change = np.ones(len(rows), bool)
        change[1:] = (words.part[1:] != words.part[:-1]) | (rows[1:] != rows[:-1])
        sentence = np.cumsum(change) - 1
        hashes, of = [words.hashes], [sentence]
        for stem in words.stems:
            longer = stem != 0
            hashes.append(stem[longer])
            of.append(sentence[longer])
        word = (np.concatenate(hashes) % np.uint64(FEATURES)).astype(np.int32)
        yield words.first, words.last, Sentences(word, np.concatenate(of), rows[change])


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def sentence_hazards(weights: np.ndarray, found: Sentences) -> np.ndarray:
    """By sentence, -log(1 - score)."""
    evidence = np.bincount(found.sentence, weights[found.word], len(found.document))
    hazards = _softplus(BIAS + evidence) - _softplus(np.float64(BIAS))
    return np.where(hazards >= LEAST_SCORE, hazards, 0.0)


def document_scores(weights: np.ndarray, found: Sentences, documents: int) -> np.ndarray:
    """Noisy-or over sentences."""
    return 1 - np.exp(-np.bincount(found.document, sentence_hazards(weights, found), documents))


def telling(docs: np.ndarray, hits: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Words that toxic documents hold significantly more often. docs, hits: by word, documents and toxic ones that hold it."""
    if not toxic or not clean:
        return np.zeros(0, np.int64)
    share = docs / (toxic + clean)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / toxic + 1 / clean))
    return np.flatnonzero((docs >= LEAST_DOCS) & (hits / toxic - (docs - hits) / clean >= LEAST_ERRORS * error))


def fit(found: Sentences, labels: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Weights of words. found: places of the words named, numbered among all sentences that hold one; labels: by document, 0 or 1."""
    weights = np.zeros(FEATURES)
    if not len(names) or not len(found.word):
        return weights
    word = np.searchsorted(names, found.word)
    document = found.document
    w, mean, square = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    positive, leak = labels > 0, _softplus(np.float64(BIAS))
    for step in range(1, ROUNDS + 1):
        z = BIAS + np.bincount(found.sentence, w[word], len(document))
        total = np.bincount(document, np.maximum(0, _softplus(z) - leak), len(labels)) + 1e-3
        pull = np.where(positive, -1 / np.expm1(np.minimum(total, 50)), 1.0) / len(labels)
        slope = pull[document] / (1 + np.exp(-z))
        gradient = np.bincount(word, slope[found.sentence], len(names)) + L2 / len(labels) * w
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    weights[names] = w
    return weights


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, text, toxic of at most `most` documents and `most_bytes` bytes of each label, none held out: those with the smallest hashes."""
    named = labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).where("labelled is not null and toxic is not null")
    named = named.where(~held_out(F.col("labelled"))).groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    order = ["h", "labelled"]
    named = named.withColumn("h", F.xxhash64("labelled"))
    chosen = named.where("toxic > 0").orderBy(*order).limit(most).union(named.where("toxic <= 0").orderBy(*order).limit(most))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).dropDuplicates(["doc_id"])
    sofar = Window.partitionBy(F.col("toxic") > 0).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    read = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(sofar)
    return found.withColumn("read", read).where(F.col("read") <= most_bytes).select("doc_id", "text", "toxic")


def trained(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_DOCS) -> np.ndarray:
    """Weights fitted to a bounded sample. The driver gets numbers of documents by word, FEATURES at most, and the places of telling words."""
    rows = stored(training_rows(docs, labels, doc_id, text, most), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, hits = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy() > 0
            for first, last, found in sentences(batch.column("text")):
                pairs = np.unique(found.document[found.sentence].astype(np.int64) * FEATURES + found.word)
                document, word = np.divmod(pairs, FEATURES)
                np.add.at(docs, word, 1)
                np.add.at(hits, word, toxic[first:last][document])
        word = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int32()), pa.array(docs[word]), pa.array(hits[word])], ["word", "docs", "hits"])

    summed = rows.mapInArrow(count, "word int, docs long, hits long").groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("hits").alias("hits"))
    counts = summed.where(F.col("docs") >= LEAST_DOCS).toArrow()
    kinds = {r.toxic: r.n for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    by_word = [np.zeros(FEATURES, np.int64) for _ in range(2)]
    for all_words, column in zip(by_word, ("docs", "hits"), strict=True):
        all_words[counts.column("word").to_numpy()] = counts.column(column).to_numpy()
    names = telling(*by_word, kinds.get(True, 0), kinds.get(False, 0))
    is_telling = np.zeros(FEATURES, bool)
    is_telling[names] = True

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found in sentences(batch.column("text")):
                use = is_telling[found.word]
                told, sentence = np.unique(found.sentence[use], return_inverse=True)
                of = found.document[told]
                order = np.argsort(sentence, kind="stable")
                word, sizes = found.word[use][order], np.bincount(sentence, minlength=len(told))
                cuts = np.searchsorted(of, np.arange(last - first + 1))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                words = [word[ends[a] : ends[b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                arrays = [pa.array(words, pa.list_(pa.int32())), pa.array([sizes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int32())), batch.column("toxic").slice(first, last - first)]
                yield pa.RecordBatch.from_arrays(arrays, ["words", "sizes", "toxic"])

    places = rows.mapInArrow(read, "words array<int>, sizes array<int>, toxic int").toArrow()
    column = lambda name: places.column(name).combine_chunks()
    word, size, toxic = column("words").flatten().to_numpy(), column("sizes").flatten().to_numpy(), column("toxic").to_numpy()
    per_document = np.diff(column("sizes").offsets.to_numpy()) if places.num_rows else np.zeros(0, np.int64)
    numbers = lambda counts: np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    return fit(Sentences(word, numbers(size), numbers(per_document)), toxic, names)


def scored(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, last, found in sentences(batch.column("text")):
                scores[first:last] = document_scores(held.value, found, last - first)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def offending(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text", least: float = TOXIC) -> DataFrame:
    """Sentences that score at least so much: doc_id, sentence (their number, from 0, among those with a word), score."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, found in sentences(batch.column("text")):
                scores = 1 - np.exp(-sentence_hazards(held.value, found))
                hits = np.flatnonzero(scores >= least)
                nth = hits - np.searchsorted(found.document, found.document[hits])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(first + found.document[hits])), pa.array(nth), pa.array(scores[hits])], ["doc_id", "sentence", "score"])

    return rows.mapInArrow(find, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, sentence long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that score below TOXIC, with all their columns as they came."""
    held = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, doc_id, text).astype(np.float32))
    at = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for first, last, found in sentences(batch.column(at)):
                keep[first:last] = document_scores(held.value, found, last - first) < TOXIC
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
