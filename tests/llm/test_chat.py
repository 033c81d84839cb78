"""Perspectives against a plain rendering."""

from __future__ import annotations

import random
from collections import defaultdict

from orderlake.llm.chat import BLOCK_BITS, in_blocks, perspectives, rendered

SCHEMA = "conv_id long, turn long, role string, text string"


def rows(seed=1):
    rng = random.Random(seed)
    out = []
    for conv in [*range(12), None]:
        for turn in range(rng.randrange(1, 9)):
            out.append((conv, rng.choice([turn, turn, 2, None]), rng.choice(["user", "assistant", "system", "bob", None]), rng.choice([None, "", "hi", f"é {turn} <|end|>\n"])))
    out += [(50, 0, "system", "only rules"), (51, 1, "user", "twice"), (51, 1, "user", "twice")]
    out += [(60, t, ("user", "assistant")[t % 2], "x" * (t % 11)) for t in range(3 << BLOCK_BITS)]
    return out


def brute(data):
    by = defaultdict(list)
    for conv, turn, role, text in data:
        by[conv].append((turn is not None, turn or 0, role or "unknown", text or "", turn))
    out = {}
    for conv, turns in by.items():
        for speaker in {t[2] for t in turns} - {"system"}:
            whole, masks, segments = "", [], []
            for _, _, role, text, turn in sorted(turns, key=lambda t: t[:4]):
                head = "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user name={role}|>\n"
                start = len(whole)
                whole += f"{head}{text}<|end|>\n"
                segments.append((turn, whole[start:], start, len(whole)))
                if role == speaker:
                    masks.append((start + len(head), len(whole) - 1))
            out[conv, speaker] = whole, masks, segments
    return out


def test_perspectives(spark):
    got = defaultdict(list)
    for r in perspectives(spark.createDataFrame(rows(), SCHEMA).repartition(3)).collect():
        got[r.conv_id, r.speaker].append(r)
    expected = brute(rows())
    assert set(got) == set(expected)
    for key, (whole, masks, segments) in expected.items():
        turns = sorted(got[key], key=lambda r: r.char_start)
        assert [(r.turn, r.segment, r.char_start, r.char_end) for r in turns] == segments
        assert "".join(r.segment for r in turns) == whole
        assert [(r.mask_start, r.mask_end) for r in turns if r.mask_end > r.mask_start] == masks


def test_windows_hold_everything_once(spark):
    expected = brute(rows())
    windows = defaultdict(list)
    for r in rendered(perspectives(spark.createDataFrame(rows(), SCHEMA)), 500).collect():
        windows[r.conv_id, r.speaker].append((r.window, r.text, r.masks))
    for key, (whole, masks, _) in expected.items():
        parts = sorted(windows[key])
        assert "".join(text for _, text, _ in parts) == whole
        learned = [text[m.start : m.end] for _, text, found in parts for m in found]
        assert learned == [whole[a:b] for a, b in masks]


def test_other_columns_and_no_rows(spark):
    turns = spark.createDataFrame(rows(), SCHEMA)
    more = turns.selectExpr("*", "1 as speaker", "2 as block", "'x' as segment", "3 as length", "4 as of")
    assert perspectives(more).count() == perspectives(turns).count()
    assert perspectives(turns.limit(0)).count() == 0


def test_turns_without_numbers_make_many_blocks(spark):
    """A conversation whose turns have no number, or all the same, is cut as any other."""
    data = [(1, None, ("user", "assistant")[i % 2], f"t{i}") for i in range(1500)] + [(2, 7, "user", "same")] * 1500
    said = spark.createDataFrame(data, SCHEMA).repartition(5)
    sizes = in_blocks(said).groupBy("conv_id", "block").count().collect()
    assert max(r["count"] for r in sizes) <= 1 << BLOCK_BITS and len(sizes) >= 10
    expected = brute(data)
    got = defaultdict(list)
    for r in perspectives(said).collect():
        got[r.conv_id, r.speaker].append(r)
    for key, (whole, _, _) in expected.items():
        assert "".join(r.segment for r in sorted(got[key], key=lambda r: r.char_start)) == whole
