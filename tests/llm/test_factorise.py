"""The linear-time pair term, and accuracy on held-out rows."""

import os

import numpy as np
import pytest

from airlattice.llm import factorise as M
from airlattice.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_pair_term_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = M.Machine(0.3, rng.normal(size=M.SLOTS), rng.normal(size=(M.SLOTS, M.FACTORS)))
    for n in (1, 2, 9):
        slots, x = rng.choice(M.SLOTS, n), rng.normal(size=n)
        pairs = sum(m.v[slots[i]] @ m.v[slots[j]] * x[i] * x[j] for i in range(n) for j in range(i))
        want = m.w0 + m.w[slots] @ x + pairs
        assert abs(M.raw_scores(m, slots, x, np.array([0]))[0] - want) < 1e-9


def test_learns_a_pair():
    """Only the two words together decide: no linear score can tell."""
    a, b = (np.array([5, 6]), np.array([0.7, 0.7])), (np.array([7, 8]), np.array([0.7, 0.7]))
    c, d = (np.array([5, 8]), np.array([0.7, 0.7])), (np.array([7, 6]), np.array([0.7, 0.7]))
    rows = [(*a, 1), (*b, 1), (*c, 0), (*d, 0)] * 50
    m = M.fit(rows, epochs=60)
    scores = [M.raw_scores(m, *x, np.array([0]))[0] for x in (a, b, c, d)]
    assert min(scores[:2]) > 0 > max(scores[2:])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no shared tables")
def test_held_out_rows(shipped):
    docs, labels = table(shipped, FOLDER, "documents"), table(shipped, FOLDER, "labels")
    scored = M.score_quality(docs, M.train(docs, labels))
    rows = scored.join(labels, "doc_id").where("quality_score.held_out").select("quality", "quality_score.predicted").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert sum(r.predicted for r in good) / len(good) > 0.98 and sum(r.predicted for r in bad) / len(bad) < 0.3


def test_ids_sources_and_labels_are_no_inputs(frame, shipped):
    docs = frame([(k, f"text number {k % 2}") for k in range(1, 9)])
    labels = shipped.createDataFrame([(k, k % 2) for k in range(1, 9)], "doc_id LONG, quality INT")
    m = M.train(docs, labels)
    by_text = {}
    for r in M.score_quality(docs, m).collect():
        by_text.setdefault(r.text, set()).add(r.quality_score.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_odd_rows(frame, shipped):
    docs = frame([(None, None), (1, ""), (1, ""), (2, "x " * 50_000)], extra=["quality_score"])
    nobody = shipped.createDataFrame([], "doc_id LONG, quality INT")
    rows = M.score_quality(docs, M.train(docs, nobody)).collect()
    assert len(rows) == 4 and all(r.quality_score_1.score == 0.5 and r.quality_score_1.predicted == 1 for r in rows)
    assert [r.quality_score_1.held_out for r in rows if r.doc_id is None] == [False]
    assert M.score_quality(frame([]), M.train(frame([]), nobody)).count() == 0
