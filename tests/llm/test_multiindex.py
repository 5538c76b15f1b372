"""Search against brute force."""

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from airlattice.llm import multiindex as M


def brute(rows, every=20, top=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            scores = np.zeros(len(ids))
            for k in range(x.shape[1]):
                scores += q[k] * x[:, k]
            order = [k for k in np.lexsort((ids, -scores)) if ids[k] != i][:top]
            out[int(i)] = [(int(ids[k]), float(scores[k])) for k in order]
    return out


def found(df, **kw):
    out = defaultdict(list)
    for r in sorted(M.nearest(df, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def vectors(shipped, rows, extra=""):
    return shipped.createDataFrame(rows, f"vec_id LONG, embedding ARRAY<FLOAT>{extra}").repartition(4)


def test_whole_share_is_exact_with_ties(shipped):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).astype("f4").tolist()) for k in range(300)]
    rows += [(300 + k, rows[k % 5][1]) for k in range(200)]
    assert found(vectors(shipped, rows), share=1.0) == brute(rows)


def test_recall_of_clustered_vectors(shipped):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + 0.3 * rng.normal(size=16)).astype("f4").tolist()) for k in range(6000)]
    got, want = found(vectors(shipped, rows), share=0.1, at_least=300), brute(rows)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall > 0.9
    assert all(abs(s - dict(want[q]).get(i, s)) == 0 for q in want for i, s in got[q])


def test_vectors_that_take_no_part(shipped):
    good = [(k, [float(k + 1), 1.0]) for k in range(45)]
    bad = [(100, None), (120, [0.0, 0.0]), (140, [float("nan"), 1.0]), (160, [float("inf"), 1.0]), (180, [None, 1.0]),
           (200, []), (None, [1.0, 1.0])]
    assert found(vectors(shipped, good + bad)) == brute(good)
    assert found(vectors(shipped, [(20, [1.0, 2.0]), (21, [2.0, 1.0])])) == {20: [(21, 4.0)]}
    assert found(vectors(shipped, [])) == {} and found(vectors(shipped, [(20, [1.0])])) == {}


def test_hot_cell_is_split(shipped, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 50)
    rows = [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(400)] + [(400 + k, [float(k), 1.0, -2.0, 0.5]) for k in range(200)]
    assert found(vectors(shipped, rows), share=1.0) == brute(rows)


@pytest.mark.parametrize("enough", [1, 50, 10**9])
def test_traversal_order(enough):
    rng = np.random.default_rng(5)
    d1, d2, counts = rng.random(9), rng.random(7), rng.integers(0, 4, (9, 7))
    order = sorted(((d1[i] + d2[j], i, j) for i in range(9) for j in range(7)))
    want, held = [], 0
    for _, i, j in order:
        if held >= enough:
            break
        if counts[i, j]:
            want.append((i, j))
            held += counts[i, j]
    assert M.traverse(d1, d2, counts, enough) == want
    assert heapq.nsmallest(1, order)[0][1:] == order[0][1:]


@pytest.mark.parametrize("kind", ["random", "ties", "few"])
def test_staircase_is_the_traversal(kind):
    """A few numbers for each query say which cells the heap visits, wherever it sets out."""
    rng = np.random.default_rng(6)
    for n, m in ((1, 1), (1, 40), (40, 1), (30, 50)):
        d1, d2 = (rng.integers(0, 6, k) / 10 if kind == "ties" else rng.random(k) for k in (n, m))
        counts = rng.integers(0, 4, (n, m)) * (rng.random((n, m)) < (0.1 if kind == "few" else 1))
        for enough in (1, 2, counts.sum() // 2 + 1, counts.sum(), counts.sum() + 1):
            rank, reach = M.staircase(d1, d2, counts, enough)
            visited = np.argwhere((rank < reach[:, None]) & (counts > 0)).tolist()
            assert visited == sorted(map(list, M.traverse(d1, d2, counts, enough)))
            behind, held = M.leap(d1, d2, counts, enough)
            assert held < max(1, enough) and held == counts[rank < behind[:, None]].sum()


def test_a_query_is_sent_in_few_bytes(shipped, monkeypatch):
    """What goes to the blocks for a query does not grow with its cells, here some 2,000 (of 40,000) that hold the vectors."""
    def sizes(*_):
        def run(batches):
            for batch in batches:
                asked = batch.filter(batch.column("ask"))
                if len(asked):
                    n = sum(c.nbytes for c in asked.columns) / len(asked)
                    yield pa.RecordBatch.from_pydict({"query_row": [asked.column("row")[0].as_py()], "query_id": [20], "vec_id": [20], "score": [n]})
        return run

    monkeypatch.setattr(M, "_nearest", sizes)
    rng = np.random.default_rng(7)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(2000, 16)).astype("f4"))]
    got = M.nearest(vectors(shipped, rows), centroids=200).collect()
    assert got and max(r.score for r in got) < 1000


def test_scores_closer_than_single_precision(shipped):
    """Candidates are found in single precision, but ranks and scores are those of doubles, of whatever size."""
    rng = np.random.default_rng(9)
    rows = [(k, (1 + 1e-11 * rng.normal(size=6)).tolist()) for k in range(300)]
    for scale in (1.0, 1e100, 1e-100, 1e-160):
        scaled = [(k, [scale * c for c in v]) for k, v in rows]
        df = shipped.createDataFrame(scaled, "vec_id LONG, embedding ARRAY<DOUBLE>").repartition(4)
        assert found(df, share=1.0, every=100) == brute(scaled, every=100)


def test_blocks_of_all_shapes(shipped, monkeypatch):
    """Rows and columns of cells in bands, parts of hot cells, several batches of queries: all vectors meet all queries once."""
    monkeypatch.setattr(M, "LEAST", 20)
    rng = np.random.default_rng(10)
    rows = [(k, rng.normal(size=5).astype("f4").tolist()) for k in range(900)] + [(900 + k, [1.0, 2.0, 3.0, 4.0, 5.0]) for k in range(300)]
    for block, pairs in ((50, 100), (500, 10_000)):
        monkeypatch.setattr(M, "BLOCK", block)
        monkeypatch.setattr(M, "PAIRS", pairs)
        assert found(vectors(shipped, rows), share=1.0) == brute(rows)


def test_sample_of_one_id(shipped):
    """Rows that share an id share its hash, so the sample may lie above the bound that most ids go by."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2500, 4))
    for i in (1, 2, 3, 4, 5):
        rows = M.usable(shipped.createDataFrame([(i, v.tolist()) for v in x], "vec_id LONG, embedding ARRAY<DOUBLE>"))
        book = M.fit_codebook(rows, sample=50)
        assert book.first.shape == (29, 2) and book.second.shape == (29, 3) and np.isfinite(book.first).all()


def test_packing():
    block, parts = M.pack([10, 30, 100, 5, 5], most=40)
    assert block == [0, 0, 1, 2, 2] and parts == [1, 3, 1]


def test_bands():
    assert M._bands(np.array([0, 0, 10, 30, 0, 20, 5, 0]), 20) == [0, 6, 8]
    assert M._bands(np.array([3]), 40) == [0, 1]


def test_repeated_ids_are_rows_of_their_own(shipped):
    """Rows that share an id, alike or not, are all candidates; a query leaves out only its own row."""
    rows = [(k, [float(k), 1.0]) for k in range(1, 30)] + [(40, [50.0, 50.0]), (40, [1.0, -1.0]), (7, [7.0, 1.0]), (7, [7.0, 1.0]), (20, [20.0, 1.0])]
    got = sorted(tuple(r) for r in M.nearest(vectors(shipped, rows), top=4).collect())
    want = []
    for k, (i, q) in enumerate(rows):
        if i % 20 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(rows) if m != k))[:4]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert got == sorted(want)


def test_each_length_is_searched_by_itself(shipped):
    two, three = [(k, [float(k), 1.0]) for k in range(1, 45)], [(100 + k, [1.0, float(k), 2.0]) for k in range(45)]
    assert found(vectors(shipped, two + three + [(500, [1.0])])) == brute(two) | brute(three)


def test_recall_with_production_parameters(shipped):
    """12,000 vectors of 64 independent components, as in the tables; queries are the first 300 divisible by 20."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(12_000, 64)).astype("f4")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(k if k <= 6000 or k % 20 else k + 1_000_001, v.tolist()) for k, v in enumerate(x)]
    got = found(vectors(shipped, rows))
    scores = x[::20][:300].astype(float) @ x.astype(float).T
    ids, hits = np.array([i for i, _ in rows]), 0
    for n in range(300):
        scores[n, 20 * n] = -np.inf
        hits += len({i for i, _ in got[20 * n]} & set(ids[np.argsort(-scores[n])[:20]].tolist()))
    assert hits / 6000 >= 0.9


def test_query_contract(shipped):
    from airlattice.llm import queries
    got = queries.QUERIES["op10_multi_index"](shipped, "/root/testdata/sf0.001")
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = [(r.vec_id, r.embedding) for r in shipped.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    have = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        have[r.query_id].append((r.vec_id, r.score))
    assert have == brute(rows)
