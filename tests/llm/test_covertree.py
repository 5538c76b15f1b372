"""Hard negatives against brute force, and the tree's promises."""

import math
from collections import Counter

import numpy as np
import pytest

from airlattice.llm import covertree as C
from airlattice.llm import queries

ROWS = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT"


def brute(rows, every=100):
    use = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, (a, v, label) in enumerate(use):
        if a is None or a % every:
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), i, other) for j, (i, w, other) in enumerate(use) if j != k and len(w) == len(v)]
        for ps, positive, _ in sorted((s for s in scored if s[2] == label), key=key)[:5]:
            fit = sorted((s for s in scored if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps), key=key)[:5]
            out += [(a, positive, r + 1, i, ps, s) for r, (s, i, _) in enumerate(fit)]
    return Counter(out)


def found(spark, rows, schema=ROWS, **kw):
    return Counter(tuple(r) for r in C.mine_negatives(spark.createDataFrame(rows, schema).repartition(3), **kw).collect())


def test_clustered_vectors_over_many_trees(shipped, monkeypatch):
    """Several top pivots, one of them hot and dealt in parts, inner nodes and closed windows."""
    monkeypatch.setattr(C, "PART", 500)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = [(k, (centres[max(0, k % 8 - 2)] * 0.3 + 0.05 * rng.normal(size=12)).tolist(), int(rng.integers(10))) for k in range(4000)]
    assert found(shipped, rows, every=50) == brute(rows, every=50)


def test_rows_that_take_no_part_ties_and_repeats(shipped):
    same = [0.5, 0.25]
    rows = [(100, same, 1), (100, same, 1), (100, same, 1), (200, same, 2), (3, same, 1), (4, same, 2), (4, same, 2), (None, same, 2), (None, same, 1),
            (5, None, 1), (6, [0.5, None], 1), (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 2), (10, same, None), (300, [0.0, 0.0], 3),
            (11, [0.0, 0.0], 3), (400, [1.0], 1), (12, [0.9], 1), (13, [0.8], 2), (500, [], 1), (15, [], 1), (16, [], 2), (600, [-0.5, -0.5], 4),
            (17, [0.5, 0.5], 4), (18, [-0.1, 0.3], 5), (0, [0.4, 0.3], 9), (700, [0.3, 0.4], 0)]
    assert found(shipped, rows) == brute(rows)


def test_few_and_no_rows(shipped):
    assert found(shipped, []) == Counter()
    assert found(shipped, [(100, None, 1)]) == Counter()
    assert found(shipped, [(100, [1.0], 1)]) == Counter()
    extra = shipped.createDataFrame([(100, [1.0], 1, 5, 5), (1, [1.0], 1, 5, 5), (2, [1.0], 2, 5, 5)], ROWS + ", row INT, n INT")
    assert [tuple(r) for r in C.mine_negatives(extra).collect()] == [(100, 1, 1, 2, 256 * 256, 256 * 256)]


def test_large_components_stay_exact(shipped):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=4) * 2e5).tolist(), int(rng.integers(3))) for k in range(0, 700, 5)]
    rows += [(1001, [1e160] * 4, 1)]  # its squared norm is no finite double
    got = found(shipped, rows)
    want = Counter((a, p, r, n, min(ps, 2**63 - 1), min(s, 2**63 - 1)) for a, p, r, n, ps, s in brute(rows).elements())
    assert {k: v for k, v in got.items() if k[4] < 2**63 - 1} == {k: v for k, v in want.items() if k[4] < 2**63 - 1}


@pytest.mark.parametrize("seed", range(3))
def test_tree_covers_all_points_within_its_radii(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(1500, 6)) * 100) if seed else np.zeros((1500, 6))
    norm = float((x * x).sum(1).max())
    tree = C.build(np.arange(1500), np.arange(1500), np.zeros(1500), x, norm)
    up, seen = C.lift(x, norm), []

    def points(node):
        leaf = tree["leaves"][node]
        return tree["place"][slice(*leaf)] if leaf is not None else np.concatenate([points(c) for c in tree["below"][node]])

    for node in range(len(tree["radii"])):
        assert (np.linalg.norm(up[points(node)] - tree["pivots"][node], axis=1) <= tree["radii"][node] + 1e-3).all()
        if tree["leaves"][node] is not None:
            seen += points(node).tolist()
    assert sorted(seen) == list(range(1500))


def test_query_contract(shipped):
    got = queries.QUERIES["op12_hard_negatives"](shipped, "/root/testdata/sf0.001")
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    rows = [(r.vec_id, r.embedding, r.label) for r in shipped.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)
