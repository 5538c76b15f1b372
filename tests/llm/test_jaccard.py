"""The join against all pairs of n-gram sets."""

import random
import time
from collections import Counter

import pytest

from airlattice.llm import jaccard as J


def gram_set(text):
    w = (text or "").encode().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(pairs):
    sets = [gram_set(t) for _, t in pairs]
    low = -(2**63)
    ids = [low if i is None else i for i, _ in pairs]
    links, parent = Counter(), list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    first = {}
    for k in range(len(pairs)):
        first[root(k)] = min(first.get(root(k), ids[k]), ids[k])
    shown = [first[root(k)] for k in range(len(pairs))]
    return sorted((ids[k], shown[k], links[k]) for k in range(len(pairs)))


def joined(df):
    low = -(2**63)
    return sorted((low if r.doc_id is None else r.doc_id, low if r.class_id is None else r.class_id, r.n_links)
                  for r in J.join_similar(df).collect())


def near_copies(rng, n_groups, size, words=60):
    out = []
    for g in range(n_groups):
        base = [f"g{g}w{rng.randint(0, 9999)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(words)] = f"x{rng.randint(0, 99999)}"
            out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_equals_all_pairs(frame, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)
    rng = random.Random(5)
    texts = near_copies(rng, 6, 5) + near_copies(rng, 1, 40)
    texts += [texts[0]] * 6 + [None, "", "  \n", "one two", "one two", "a b c d e", "a  b\nc d e"] + [" ".join(f"u{k}{j}" for j in range(30)) for k in range(20)]
    rng.shuffle(texts)
    pairs = list(enumerate(texts))
    assert joined(frame(pairs, extra=["class_id", "n_links"])) == brute(pairs)


def test_repeated_and_null_ids(frame):
    a, b = " ".join(map(str, range(40))), " ".join(map(str, range(100, 140)))
    pairs = [(None, a), (7, a), (7, b), (7, b), (3, b), (9, "")]
    assert joined(frame(pairs)) == brute(pairs)
    assert joined(frame([])) == []


def test_many_near_copies_without_ids_or_with_one(frame):
    """Each class gets its set from its own text: no text meets the classes of other rows with the same id."""
    rng = random.Random(9)
    texts = near_copies(rng, 1, 500)
    took = {}
    for ids in (lambda k: k, lambda k: None, lambda k: 7):
        pairs = [(ids(k), t) for k, t in enumerate(texts)]
        began = time.time()
        got = joined(frame(pairs))
        took[ids(1)] = time.time() - began
        assert sum(got.values() if isinstance(got, dict) else [len(got)]) == 500
    assert max(took[None], took[7]) < 3 * took[1] + 5


def test_one_of_each_group_stays(frame):
    rng = random.Random(6)
    texts = near_copies(rng, 4, 6) + ["alone in the world of words", "", None]
    docs = frame(list(enumerate(texts)), extra=["place", "row_key"])
    kept = J.keep_one_each(docs, J.join_similar(docs))
    assert kept.columns == docs.columns
    groups = {c for _, c, _ in brute(list(enumerate(texts)))}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_rows_with_null_or_repeated_ids_stay_apart(frame):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "zbcd")
    near = b + " more"
    pairs = [(None, a), (None, c), (None, c), (7, d), (7, near), (3, b), (7, b), (None, ""), (None, None), (8, c + " end"), (5, "x y"), (5, "y x"), (5, "x y")]
    docs = frame(pairs, extra=["root", "row"])
    kept = J.keep_one_each(docs, J.join_similar(docs))
    assert kept.columns == docs.columns
    want = [(None, a), (None, c), (7, d), (3, b), (None, ""), (None, None), (5, "x y"), (5, "y x")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)


def test_band_recall():
    assert 1 - (1 - 0.8**J.ROWS) ** J.BANDS > 0.99999


def test_long_chains_are_one_group(shipped):
    edges = shipped.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "a LONG, b LONG")
    got = {r.id: r.root for r in J.connected(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, 1001: 1000}
