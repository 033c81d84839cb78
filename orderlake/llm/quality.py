"""Quality rules as a short-circuit cascade.

Each rule rejects a document by a figure of its text. What a rule costs and how much it rejects are estimated on a bounded
sample; rules are then ordered by rejections per cost, and a document that one rule rejects is not shown to the next. The
order changes the work, never the verdict: a document is kept if no rule rejects it.

Nulls, ties, repeated rows: a null or empty text has no words and is rejected for being short; null identifiers are allowed;
repeated rows each get their verdict. An empty table gives an empty result, with the rules in the order given.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.words import IS_FIRST, IS_SPACE, SPACES, byte_counts, byte_set, hashed_words, window_hashes

#: Documents on which costs and rejections are estimated. Their texts stay in tasks; a task takes them batch by batch.
SAMPLE_DOCS = 512
SYMBOLS = byte_set(b"#*$%&|<>")
WINDOW = 5
#: Texts that are judged at once.
BATCH_TEXTS = 1000

_IN_WORD = IS_FIRST & ~IS_SPACE
_UPPER = byte_set(bytes(range(65, 91)))
_LOWER = byte_set(bytes(range(97, 123)))
_BLANKS = SPACES.decode()


class Figures:
    """Figures of some texts, each computed when first asked for."""

    def __init__(self, texts: pa.Array, known: dict[str, np.ndarray] | None = None):
        self.texts = texts
        self.known: dict[str, np.ndarray] = dict(known or {})

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.known:
            self.known |= MEASURES[name](self.texts)
        return self.known[name]


def _characters(texts: pa.Array) -> dict[str, np.ndarray]:
    return dict(zip(("word_chars", "n_symbols"), byte_counts(texts, _IN_WORD, SYMBOLS), strict=True))


def _cases(texts: pa.Array) -> dict[str, np.ndarray]:
    return dict(zip(("n_upper", "n_lower"), byte_counts(texts, _UPPER, _LOWER), strict=True))


def _words(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_repeat_words: words in windows that are found twice or more in their text."""
    n = np.zeros(len(texts), np.int64)
    repeated = np.zeros(len(texts), np.int64)
    for words in hashed_words(texts, lower=False):
        n[words.first : words.last] = np.diff(words.bounds)
        for row in range(words.first, words.last):
            own = words.hashes[words.bounds[row - words.first] : words.bounds[row - words.first + 1]]
            windows = window_hashes(own, WINDOW)
            if len(windows) < 2:
                continue
            order = np.argsort(windows)
            equal = windows[order[1:]] == windows[order[:-1]]
            if not equal.any():
                continue
            starts = np.zeros(len(own) + 1, np.int64)  # +1 where a repeated window starts, -1 where it ends
            twice = np.unique(np.concatenate([order[1:][equal], order[:-1][equal]]))
            starts[twice] += 1
            starts[twice + WINDOW] -= 1
            repeated[row] = np.count_nonzero(np.cumsum(starts)[:-1])
    return {"n_words": n, "n_repeat_words": repeated}


def _lines(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_dup_lines: lines with a word that equal an earlier line."""
    lines, again = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        full = [x for x in (text.as_py() or "").split("\n") if x.strip(_BLANKS)]
        lines[row] = len(full)
        again[row] = len(full) - len(set(full))
    return {"n_lines": lines, "n_dup_lines": again}


MEASURES: dict[str, Callable[[pa.Array], dict[str, np.ndarray]]] = {
    **dict.fromkeys(("word_chars", "n_symbols"), _characters),
    **dict.fromkeys(("n_upper", "n_lower"), _cases),
    **dict.fromkeys(("n_words", "n_repeat_words"), _words),
    **dict.fromkeys(("n_lines", "n_dup_lines"), _lines),
}


@dataclass(frozen=True)
class Rule:
    """Rejects where the test holds."""

    name: str
    test: Callable[[Figures], np.ndarray]


def _over(top: str, below: str, share: float) -> Callable[[Figures], np.ndarray]:
    return lambda x: x[top] > share * np.maximum(x[below], 1)


RULES = (
    Rule("short", lambda x: x["n_words"] < 10),
    Rule("repeated words", lambda x: 100 * x["n_repeat_words"] > 20 * x["n_words"]),
    Rule("long words", _over("word_chars", "n_words", 20.0)),
    Rule("symbols", _over("n_symbols", "n_words", 0.2)),
    Rule("repeated lines", _over("n_dup_lines", "n_lines", 0.4)),
    Rule("capitals", lambda x: (x["n_upper"] > x["n_lower"]) & (x["n_upper"] > 100)),
)


def measure(rules: Sequence[Rule], texts: pa.Array, given: Sequence[str] = ()) -> list[tuple[str, float, int]]:
    """By rule: name, seconds, texts rejected. Each rule works out its own figures, as if it came first; the given ones are known before and cost nothing."""
    out = []
    known = Figures(texts)
    if len(texts):
        for name in given:
            known[name]
    for rule in rules:
        began = time.perf_counter()
        rejected = int(np.count_nonzero(rule.test(Figures(texts, known.known)))) if len(texts) else 0
        out.append((rule.name, time.perf_counter() - began, rejected))
    return out


def ordered(rules: Sequence[Rule], estimates: Iterable[tuple[str, float, float]]) -> list[Rule]:
    """Most rejections per cost first; the given order breaks ties and holds for rules without estimate."""
    worth = {name: rejected / max(cost, 1e-9) for name, cost, rejected in estimates}
    return sorted(rules, key=lambda rule: -worth.get(rule.name, 0.0))


def cascade(rules: Sequence[Rule], texts: pa.Array, known: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, int]:
    """Which texts no rule rejects, and how many texts were shown to rules in all. A rule sees what the ones before it left; figures that aren't known yet are computed for these alone."""
    left, shown = np.arange(len(texts)), 0
    figures = Figures(texts, known)
    for rule in rules:
        shown += len(left)
        rejected = rule.test(figures)
        if rejected.any():
            stays = np.flatnonzero(~rejected)
            left = left[stays]
            figures = Figures(figures.texts.take(pa.array(stays)), {name: values[stays] for name, values in figures.known.items()})
        if not len(left):
            break
    kept = np.zeros(len(texts), bool)
    kept[left] = True
    return kept, shown


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_DOCS) -> DataFrame:
    """text of at most `most` documents, those with the smallest hashes of their identifiers."""
    chosen = docs.select(F.xxhash64(doc_id).alias("h"), F.col(doc_id).alias("id")).orderBy("h", "id").limit(most).select("id")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen.distinct()), "id").select("text").limit(most)


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, given: Sequence[str] = ()) -> list[Rule]:
    """The rules in the order that a sample of the documents suggests, where the given figures are known before. Rules are timed where the texts are; the driver gets sums."""
    names = [rule.name for rule in rules]

    def time_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            measured = measure(rules, pc.fill_null(batch.column("text"), ""), given)
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*measured, strict=True)], ["rule", "seconds", "rejected"])

    timed = sample(docs, doc_id, text).mapInArrow(time_rules, "rule string, seconds double, rejected long")
    sums = timed.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    return ordered(rules, [(r.rule, r.seconds, r.rejected) for r in sums.where(F.col("rule").isin(names)).collect()])


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] | None = None, base: Sequence[str] = BASE) -> DataFrame:
    """doc_id, the figures named in base, and kept. Figures of base are asked for and computed for every row, once; what rules need besides, for the rows that come to them."""
    rules = list(rules) if rules is not None else plan(docs, doc_id, text, given=base)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + "".join(f"{name} long, " for name in base) + "kept boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(first, BATCH_TEXTS)
                texts = pc.fill_null(batch.column("text"), "")
                figures = Figures(texts)
                columns = [pa.array(figures[name]) for name in base]
                kept, _ = cascade(rules, texts, figures.known)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(kept)], ["doc_id", *base, "kept"])

    return rows.mapInArrow(judge, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
