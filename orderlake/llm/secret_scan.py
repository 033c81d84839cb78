"""Secrets in texts, told from examples by how many own them.

Base patterns find assignments, access keys and long hex strings. Besides, every token that looks random is a candidate. A
candidate's hash (never its value) is counted over the whole corpus by distinct repositories and distinct owners, partial
counts first. A candidate held by more than MOST_OWNERS owners, or MOST_REPOSITORIES repositories, is a widely copied example;
one that few hold and that looks live is a secret of its owner. Live candidates add spans of kind "live"; base spans stay.

Every pattern reads a text in time that grows with its length, whatever it holds.

Nulls, ties, repeated rows: a null text counts as empty; null owners count as one owner, as do null repositories; null
identifiers keep their spans by row. Repeated rows each give their spans and count once in the frequencies. Empty tables give
empty results. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A live secret has at most so many owners and repositories.
MOST_OWNERS = 2
MOST_REPOSITORIES = 4
#: Bits for each character that a live candidate has at least, in its own distribution of characters.
LEAST_BITS = 3.5
LEAST_LENGTH = 20

# The patterns of the base, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "live")
# Forms of well-known keys.
KNOWN = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+)")
# What follows :// in an address with a password.
ADDRESS = re.compile(r"[^\s/:@]+:[^\s/:@]+@[^\s/]+")
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
RANDOM = re.compile(rf"(?<![A-Za-z0-9+/_=.@-])[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}(?![A-Za-z0-9+/_=.@-])")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, rank of kind, end, value), in order."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def bits(value: str) -> float:
    """Entropy of the value's characters."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def looks_live(value: str) -> bool:
    """Random rather than a word, a path or a name: digits mixed with letters all over."""
    changes = sum(a.isdigit() != b.isdigit() for a, b in pairwise(value))
    return changes >= max(4, len(value) / 5) and any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and bits(value) >= LEAST_BITS


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Where addresses with a password start and end. From each :// the scheme is read backward, so that no run of letters is read twice."""
    at = text.find("://")
    while at >= 0:
        start = at
        while start and text[start - 1] in SCHEME:
            start -= 1
        while start < at and not text[start].isalpha():
            start += 1
        if start < at and (found := ADDRESS.match(text, at + 3)):
            yield start, found.end()
        at = text.find("://", at + 3)


def more_candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Spans that no base span meets and that look live."""
    found = [(m.start(), 3, m.end(), m.group()) for m in KNOWN.finditer(text)]
    found += [(low, 3, high, text[low:high]) for low, high in addresses(text)]
    found += [(m.start(), 3, m.end(), m.group()) for m in RANDOM.finditer(text) if looks_live(m.group())]
    out, end = [], -1
    starts = [low for low, *_ in base]
    reach = list(accumulate((high for _, _, high, _ in base), max, initial=0))  # by number of base spans, where the last of them ends
    for low, rank, high, value in sorted(found):
        if low >= end and reach[bisect_left(starts, high)] <= low:
            out.append((low, rank, high, value))
            end = high
    return out


FOUND = "row long, doc_id {id}, owner {owner}, repository {repository}, spans array<struct<start:int,rank:int,end:int,hash:binary>>"


def candidates(docs: DataFrame, doc_id: Column, text: Column, owner: Column, repository: Column) -> DataFrame:
    """By row its spans, with a hash of each one's value."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), owner.alias("owner"), repository.alias("repository"), text.alias("text"))
    schema = FOUND.format(id=rows.schema["doc_id"].dataType.simpleString(), owner=rows.schema["owner"].dataType.simpleString(), repository=rows.schema["repository"].dataType.simpleString())
    span = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("hash", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                found = sorted(base + more_candidates(text, base))
                spans.append([{"start": a, "rank": k, "end": b, "hash": hashlib.sha256(v.encode()).digest()[:16]} for a, k, b, v in found])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "owner", "repository")), pa.array(spans, pa.list_(span))], ["row", "doc_id", "owner", "repository", "spans"])

    return rows.mapInArrow(scan, schema)


def ownership(found: DataFrame) -> DataFrame:
    """By hash: owners, repositories, and whether it is an example. Values are made distinct before they are counted, so that a candidate that everyone holds is never gathered in one place."""
    held = found.select(F.explode("spans").alias("span"), "owner", "repository").select(F.col("span.hash").alias("hash"), "owner", "repository").distinct()
    owners = held.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    repositories = held.groupBy("hash").agg(F.count("*").alias("repositories"))
    return owners.join(repositories, "hash").withColumn("example", (F.col("owners") > MOST_OWNERS) | (F.col("repositories") > MOST_REPOSITORIES))


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """By document: doc_id, spans (start, end, kind, owners, repositories, example) in order. Examples among the candidates beyond the base are left out; base spans stay and say whether they are examples."""
    from orderlake.llm.scratch import stored

    owner = F.col("source") if owner is None else owner
    repository = owner if repository is None else repository
    found = stored(candidates(docs, F.col(doc_id), F.col(text), owner, repository), "candidates")
    verdicts = ownership(found)
    marked = (
        found.select("row", F.explode("spans").alias("span"))
        .select("row", "span", F.col("span.hash").alias("hash"))
        .join(verdicts, "hash")
        .where((F.col("span.rank") < 3) | ~F.col("example"))
        .select("row", F.struct("span.start", "span.rank", "span.end", F.element_at(F.array(*map(F.lit, KINDS)), F.col("span.rank") + 1).alias("kind"), "owners", "repositories", "example").alias("span"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )
    return found.select("row", "doc_id").join(marked, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(marked.schema["spans"].dataType)).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts by kind, and the spans as text."""
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["rank"] < 3)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id",
        *(count(kind) for kind in KINDS[:3]),
        F.sha2(F.concat_ws(",", F.transform(base, written)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", written)).alias("spans"),
        F.size(F.filter("spans", lambda s: s["example"])).cast("long").alias("n_examples"),
        F.size(F.filter("spans", lambda s: ~s["example"])).cast("long").alias("n_owned"),
    )
