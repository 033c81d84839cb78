"""Small tables with the odd rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

VOCABULARY = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "s", "t")]


def prose(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies of several degrees, blanks, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    out = []
    base = [prose(rng, rng.choice([3, 7, 30, 80, 200])) for _ in range(8)]
    passage = prose(rng, 60)
    for i in range(n):
        words = list(rng.choice(base)) if i % 2 else prose(rng, rng.randrange(1, 120))
        for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        if i % 7 == 0:
            words = words[:10] + passage + words[10:]
        text = rng.choice([" ", " ", "\n", " \t "]).join(words)
        out.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", None]), len(text)))
    odd = [(1000, None, "en", "a", None), (1001, "", None, "b", 0), (1002, " \n\x0b ", "en", None, 4), (1003, "One TWO", "en", "a", 7), (1004, "one two", "en", "b", 7)]
    odd += [(None, "a text without a name", "en", "a", 21), (None, "a text without a name", "en", "b", 21), (None, None, None, None, None)]
    odd += [out[3], out[3], (3, "another text of the same name", "de", "a", 29), (2000, " ".join(prose(rng, 30_000)), "en", "a", None)]
    return out + odd


def documents(spark, seed: int = 1, n: int = 60):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(3)


def clashing(spark, seed: int = 1):
    """Documents with further columns whose names operators use themselves."""
    names = ["row", "id", "norm", "group", "size", "copies", "target", "class", "key", "component", "n", "nth", "score", "kept", "spans", "text_x", "source_size", "of", "drawn", "piece"]
    docs = documents(spark, seed)
    return docs.selectExpr("*", *(f"map('{name}', doc_id) as `{name}`" for name in names))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
