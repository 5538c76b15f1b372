"""Base counts by their definition, and Viterbi against all labellings."""

from collections import Counter
import itertools
import random
import re

import numpy as np

from airlattice.llm import linerules as L


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_counts(frame):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a ", "b ", "c\n", "#", "é ", " ", "\x1f", "\t", "\x0b", "<", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", "\n\n", "a b c a b c", "x " * 400, " \n "]
    rows = L.judge_lines(frame(list(enumerate(texts)), extra=["rules"])).collect()
    for r in rows:
        want = base(r.text)
        got = r.rules_1
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == want, repr(r.text)
        assert got.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got.kept and got.base_failed)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(3)
    for n in range(1, 8):
        feats, w, t = rng.normal(size=(n, L.N_FEATURES)), rng.normal(size=(L.N_FEATURES, 2)), rng.normal(size=(2, 2))
        unary = feats @ w

        def score(y):
            return sum(unary[k, v] for k, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:]))
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(L.viterbi(feats, w, t)) == best
    assert len(L.viterbi(np.zeros((0, L.N_FEATURES)), w, t)) == 0


def test_likelihood_gradient():
    """Expected counts equal those of all labellings."""
    rng = np.random.default_rng(4)
    unary, t = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2))
    label, moves = L._expected(unary, t, np.ones((1, 4), bool))
    weight = {y: np.exp(sum(unary[0, k, v] for k, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:])))
              for y in itertools.product((0, 1), repeat=4)}
    z = sum(weight.values())
    for k in range(4):
        assert abs(label[0, k, 1] - sum(p for y, p in weight.items() if y[k]) / z) < 1e-9
    assert abs(moves[0, 1] - sum(p * sum((a, b) == (0, 1) for a, b in zip(y, y[1:])) for y, p in weight.items()) / z) < 1e-9


def test_verdicts(frame):
    rng = random.Random(1)
    prose = lambda: "\n".join(" ".join(f"word{rng.randint(0, 9999)}" for _ in range(12)) + "." for _ in range(8))
    junk = lambda: "\n".join(" ".join(f"w{rng.randint(0, 9999)}{rng.choice('#*$%')*3}" for _ in range(12)) for _ in range(8))
    pairs = [(k, prose() if k % 2 else junk()) for k in range(60)]
    verdict = {r.doc_id: r.rules.kept for r in L.judge_lines(frame(pairs)).collect()}
    assert all(verdict[k] == bool(k % 2) for k in verdict)
    assert L.judge_lines(frame([])).count() == 0


def test_training_lines_come_from_the_whole_text():
    """Runs are whole, in order, and drawn from the end of a text as from its start."""
    places = [L.drawn_lines(str(k), 1010, 4) for k in range(200)]
    assert all(len(p) <= 128 and (np.diff(p) > 0).all() and len(p) >= 3 * 32 for p in places)
    runs = np.concatenate([np.unique(p // 32) for p in places])
    assert set(runs) == set(range(32)) and abs(np.mean(runs) - 15.5) < 1.5
    assert L.drawn_lines("x", 70, 4).tolist() == list(range(70)) and L.drawn_lines("x", 0, 4).tolist() == []


def test_query_contract(shipped):
    from airlattice.llm import queries
    got = queries.QUERIES["op7_line_rules"](shipped, "/root/testdata/sf0.001")
    assert got.dtypes[:7] == [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
                              ("n_repeat_words", "bigint"), ("base_failed", "boolean")]
    rows = {r.doc_id: r for r in got.collect()}
    docs = shipped.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        words, r = re.findall(r"[^\x20\x09-\x0D]+", d.text or ""), rows[d.doc_id]
        windows = Counter(zip(words, words[1:], words[2:]))
        held = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in (d.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", d.text or "")), len(lines) - len(set(lines)), len(held))
        assert r.base_failed == (len(words) < 50 or 100 * len(held) > 50 * len(words)) and not (r.base_failed and r.kept)
