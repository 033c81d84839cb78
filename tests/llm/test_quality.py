"""Figures and verdicts against plain ones; the cascade's order and savings."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm.quality import BASE, RULES, Figures, Rule, cascade, judged, measure, ordered, plan
from tests.llm.corpus import clashing, documents, empty, rows


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times = Counter(windows)
    covered = {k + i for k, w in enumerate(windows) if times[w] > 1 for i in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab #|é\n\t\x0b", max_size=80)), min_size=1, max_size=8))
def test_figures(texts):
    figures = Figures(pa.array(texts, pa.string()).fill_null(""))
    got = list(zip(*(figures[name].tolist() for name in BASE), strict=True))
    assert got == [plain(t) for t in texts]


def test_documents(spark):
    got = judged(documents(spark)).collect()
    assert Counter((r.doc_id, *(r[name] for name in BASE)) for r in got) == Counter((r[0], *plain(r[1])) for r in rows())
    assert {r.kept for r in got} == {True, False}
    assert not any(r.kept for r in got if r.n_words < 10)


def test_the_order_changes_work_and_no_verdict():
    texts = pa.array([r[1] or "" for r in rows(3)] + ["# " * 60, "SHOUTING " + "ABCDEFGH " * 30])
    verdicts = [cascade(order, texts) for order in (RULES, RULES[::-1], ordered(RULES, measure(RULES, texts)))]
    assert all((kept == verdicts[0][0]).all() for kept, _ in verdicts)
    each = np.all([~rule.test(Figures(texts)) for rule in RULES], axis=0)
    assert (verdicts[0][0] == each).all()


def test_rules_are_ordered_by_rejections_per_cost():
    names = ["dear", "idle", "good"]
    rules = [Rule(n, lambda x: x["n_words"] < 0) for n in names]
    assert [r.name for r in ordered(rules, [("dear", 1.0, 0.5), ("idle", 0.1, 0.0), ("good", 0.1, 0.2)])] == ["good", "dear", "idle"]


def test_a_rejected_text_is_not_shown_again():
    seen = []

    def watching(name, rejects):
        def test(figures):
            seen.append((name, len(figures.texts)))
            return np.array([x.as_py() in rejects for x in figures.texts], bool)

        return Rule(name, test)

    kept, shown = cascade([watching("a", {"x"}), watching("b", {"y"})], pa.array(["x", "y", "z", "x"]))
    assert kept.tolist() == [False, False, True, False]
    assert seen == [("a", 4), ("b", 2)] and shown == 6


def test_other_columns_and_no_rows(spark):
    docs = clashing(spark)
    assert judged(docs).count() == docs.count()
    assert judged(empty(spark)).count() == 0
    assert len(plan(empty(spark))) == len(RULES)
