"""Targets, subset sums and the mix, against small brute-force versions."""

import itertools
import random
import tracemalloc
from collections import defaultdict

import pytest

from airlattice.llm import budget as B


def test_fill_is_the_best_subset():
    rng = random.Random(1)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 30), rng.randint(1, 4)), reverse=True)
        counts = [rng.randint(0, 4) for _ in lengths]
        budget = rng.randint(0, 120)
        take = B.fill(budget, lengths, counts)
        sums = {sum(n * t for n, t in zip(lengths, ts)) for ts in itertools.product(*[range(c + 1) for c in counts])}
        assert all(0 <= t <= c for t, c in zip(take, counts))
        assert sum(n * t for n, t in zip(lengths, take)) == max(s for s in sums if s <= budget)


def test_one_very_long_document_needs_little_memory():
    """Thousands of lengths beside one of a million words; all even, so the odd budget is never met and no part is left out."""
    rng = random.Random(2)
    lengths = sorted({2 * rng.randrange(1, 50_000) for _ in range(3000)} | {1_000_000}, reverse=True)
    counts = [rng.randrange(1, 4) for _ in lengths]
    budget = sum(n * c for n, c in zip(lengths, counts)) // 3 | 1
    tracemalloc.start()
    take = B.choose(budget, lengths, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n * t for n, t in zip(lengths, take)) == budget - 1
    assert all(0 <= t <= c for t, c in zip(take, counts)) and peak < 300e6


def test_choose_keeps_bounds_beyond_the_table():
    rng = random.Random(2)
    for _ in range(100):
        lengths = sorted(rng.sample(range(1, 4000), 20), reverse=True)
        counts = [rng.randint(0, 300) for _ in lengths]
        whole = sum(n * c for n, c in zip(lengths, counts))
        budget = rng.randint(0, whole)
        take = B.choose(budget, lengths, counts, table_words=500)
        taken = sum(n * t for n, t in zip(lengths, take))
        assert all(0 <= t <= c for t, c in zip(take, counts)) and budget - max(lengths) < taken <= budget


def test_targets():
    assert B.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    got = B.targets([10, 100, 100], [5, 2, 1])
    assert got[0] == 30 and got[1:] == pytest.approx([120, 60])
    assert sum(B.targets([1, 0, 50, 7], [5, 2, 1, 5])) == pytest.approx(58)
    assert B.targets([], []) == [] and B.targets([0, 0], [5, 2]) == [0, 0]


def by_source(rows):
    out = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        out[r.source][0] += r.taken
        out[r.source][1] = r.source_size
        out[r.source][2] = r.target
    return out


def test_mix(shipped):
    rng = random.Random(3)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", "d", None])) for k in range(600)]
    rows += [(1000 + k, " ".join(["same"] * 10), "hot") for k in range(500)] + [(5000, None, "a"), (5001, "", "empty"), (None, "x y", "b"), (None, "x y", "b")]
    docs = shipped.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    mix = B.mix_sources(docs).collect()
    assert len(mix) == len(rows) and all(0 <= r.times <= 3 and r.taken == r.size * r.times for r in mix)
    sources = by_source(mix)
    order = sorted((s for s in sources if s is not None)) + [None]
    want = B.targets([sources[s][1] for s in order], [B.WEIGHTS[k % 3] for k in range(len(order))])
    for s, target in zip(order, want):
        assert sources[s][2] == target and abs(sources[s][0] - target) <= 1.0 or s == "hot" and abs(sources[s][0] - target) <= 10
    again = B.mix_sources(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, mix))


def test_apply(frame):
    docs = frame([(k, "w " * (k + 1)) for k in range(30)], extra=["copy", "mix_times"])
    mix = B.mix_sources(docs)
    out = B.apply_mix(docs, mix)
    assert out.columns == docs.columns
    times = {r.doc_id: r.times for r in mix.collect()}
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert {k: t for k, t in times.items() if t} == dict(got)


def test_apply_takes_rows_not_ids(shipped):
    rng = random.Random(4)
    rows = [(rng.choice([None, None, 1, 2]), " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 9))), rng.choice(["a", "b", "c", None]), k % 2) for k in range(300)]
    rows += [(None, "one row often", "a", 0)] * 41 + [(None, "a", None, 0), (None, None, "a", 0)]
    docs = shipped.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, row INT").repartition(3)
    mix = B.mix_sources(docs)
    out = B.apply_mix(docs, mix)
    assert out.columns == docs.columns
    want, got = defaultdict(int), defaultdict(int)
    for r in mix.collect():
        want[r.doc_id, r.source, r.size] += r.times
    for r in out.collect():
        got[r.doc_id, r.source, len((r.text or "").split())] += 1
    assert {k: t for k, t in want.items() if t} == dict(got)


def test_empty(frame):
    assert B.mix_sources(frame([])).count() == 0
    assert [(r.times, r.target) for r in B.mix_sources(frame([(1, None)])).collect()] == [(0, 0.0)]
