"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised by its own centroids; a pair of centroids is a cell. For a query
the cells are traversed by increasing sum of the two half distances with a heap, until they hold enough
entries. The entries found are reranked by the exact inner product on the original vectors.

The cells behind a traversal are a staircase: of each first centroid, so many second ones, the nearest to the query.
It is stated by two short lists, whatever the number of cells, and the heap sets out from the last staircase under a
bound on the sum that certainly holds too few entries.

For the largest inner product every vector gets one more component, sqrt(M^2 - |x|^2) with M the largest norm,
and a query a zero there: then the nearest vector is the one with the largest inner product.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from airlattice.llm.common import col, discard, row_type, stored

#: Most vectors of one part of a block, of 64 components (fewer longer ones). A block is a rectangle of cells: neighbouring
#: first centroids with neighbouring second ones; those with more vectors are dealt out by hash.
BLOCK = 65_536
#: Every query goes to every block that it visits, so fewer vectors than would fill them make about so many blocks,
BLOCKS = 24
#: of at least so many vectors.
LEAST = 512
#: Share of the vectors that a query's cells hold. Vectors of 64 almost independent components need so much for a
#: recall over 0.9; clustered ones need far less.
SHARE = 0.5
#: Queries that are traversed, or scored against a block, at once, and the pairs of a query and a vector among them.
QUERIES, PAIRS = 256, 1 << 20
#: Points whose distances to all centroids are held at once.
POINTS = 1024
#: Cells that are left to the heap, about, when it sets out.
AHEAD = 64


@dataclass
class Codebook:
    """Centroids of the two halves, the largest norm, and how many vectors each cell holds."""

    first: np.ndarray
    second: np.ndarray
    norm: float
    counts: np.ndarray | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of stored vectors, the norm component in the second."""
        extra = np.sqrt(np.maximum(self.norm**2 - (x**2).sum(1), 0.0))
        h = x.shape[1] // 2
        return x[:, :h], np.concatenate([x[:, h:], extra[:, None]], 1)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)[None, :]


def closest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and the squared distance."""
    own, far = np.empty(len(x), np.int64), np.empty(len(x))
    for at in range(0, len(x), POINTS):
        d = _squares(x[at:at + POINTS], c)
        own[at:at + POINTS], far[at:at + POINTS] = d.argmin(1), d.min(1)
    return own, far


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids; one that loses all its points moves to the point farthest from its own."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].astype(float)
    for _ in range(rounds):
        own, far = closest(x, c)
        size = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
        empty = np.flatnonzero(size == 0)
        if len(empty):
            c[empty] = x[np.argsort(-far, kind="stable")[:len(empty)]]
    return c


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, id, v): vectors, of floats where they come as such and doubles else, without null, zero, or non-finite components.

    Rows without id take no part. Rows that share an id are rows of their own, told apart by ``row``; store the frame
    before it is read twice.
    """
    floats = T.ArrayType(T.FloatType())
    v = col(vector).cast(floats if vectors.select(col(vector)).schema[0].dataType == floats else T.ArrayType(T.DoubleType()))
    return vectors.select(F.monotonically_increasing_id().alias("row"), col(vec_id).cast("long").alias("id"), v.alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
        " AND exists(v, x -> x <> 0)")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1 if len(whole) else 0)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x, dtype=float))


def _shortened(x: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Vectors over a norm, in single precision; zeros, which tell nothing apart, where the norm's square has no place."""
    right = (norm > 1e-140) & (norm < 1e140)
    return np.where(right, x / np.where(right, norm, 1), 0).astype(np.float32)


def fit_codebook(vectors: DataFrame, centroids: int | None = None, sample: int = 20_000) -> Codebook | None:
    """Centroids from the ``sample`` vectors with the smallest hashed ids, the bound of what reaches the driver.

    Without ``centroids`` each half gets sqrt(n / 3) of them, 4 to 1024, so that a cell holds some three vectors.
    No vectors give no codebook.
    """
    n, norm = vectors.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).first()
    if not n:
        return None
    k = centroids or int(min(1024, max(4, round((n / 3) ** 0.5))))
    hashed = F.xxhash64("id")
    first_ones = lambda df: _matrix(df.orderBy(hashed, "id", "row").limit(sample).select("v").toArrow()["v"]).astype(float)
    # So few hashes hold the sample, as a rule, and tasks send little more than it.
    x = first_ones(vectors.where(hashed <= min(int((1.2 * sample + 1000) / n * 2**64) - 2**63, 2**63 - 1)))
    if len(x) < min(sample, n):
        x = first_ones(vectors)
    book = Codebook(np.zeros((0, 0)), np.zeros((0, 0)), float(norm) ** 0.5)
    first, second = book.halves(x)
    book.first, book.second = k_means(first, k), k_means(second, k, seed=11)
    return book


def traverse(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int, reach: np.ndarray | None = None, held: int = 0) -> list[tuple[int, int]]:
    """Cells (first, second centroid) by increasing d1 + d2 until they hold ``enough`` vectors; empty ones are left out.

    ``reach`` and ``held``, as of ``leap``, say which cells are behind already.
    """
    a, b = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    x, y, left = d1[a].tolist(), d2[b].tolist(), [0] * len(a) if reach is None else reach[a].tolist()
    a, b, n, m = a.tolist(), b.tolist(), len(a), len(b)
    out = []
    # A pair is in the heap when both its neighbours before it have left.
    heap = [(x[i] + y[j], i, j) for i, j in enumerate(left) if j < m and (i == 0 or left[i - 1] > j)]
    heapq.heapify(heap)
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        if here := counts.item(a[i], b[j]):
            out.append((a[i], b[j]))
            held += here
        left[i] = j + 1
        if j + 1 < m and (i == 0 or left[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < n and left[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
    return out


def leap(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> tuple[np.ndarray, int]:
    """Of each first centroid how many second ones, by increasing d2, are cells under some sum, and how many vectors these hold.

    They hold fewer than ``enough``, so a traversal passes them all before any other; about AHEAD cells more hold enough.
    """
    b = np.argsort(d2, kind="stable")
    y, m, each = d2[b], len(b), np.arange(len(d1))
    holds = np.zeros((len(d1), m + 1), np.int64)
    np.cumsum(counts.take(b, axis=1), axis=1, out=holds[:, 1:])
    lo, hi, reach, held, most = d1.min() + y[0], d1.max() + y[-1], np.zeros(len(d1), np.int64), 0, m * len(d1)
    if holds[:, m].sum() < enough:
        return np.full(len(d1), m), int(holds[:, m].sum())
    while most - reach.sum() > AHEAD and lo < (mid := lo + (hi - lo) / 2) < hi:
        under = np.searchsorted(y, mid - d1)
        # The difference is rounded; it is the sum that counts, as in the heap.
        while (off := ((under < m) & (d1 + y[np.minimum(under, m - 1)] < mid)).astype(int) - ((under > 0) & (d1 + y[under - 1] >= mid))).any():
            under += off
        if (n := int(holds[each, under].sum())) < enough:
            lo, reach, held = mid, under, n
        else:
            hi, most = mid, under.sum()
    return reach, held


def staircase(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells that ``traverse`` visits: those whose second centroid's rank is under the reach of their first one."""
    rank = np.empty(len(d2), np.int64)
    rank[np.argsort(d2, kind="stable")] = np.arange(len(d2))
    reach, held = leap(d1, d2, counts, enough)
    for i, j in traverse(d1, d2, counts, enough, reach, held):
        reach[i] = max(reach[i], rank[j] + 1)
    return rank, reach


def pack(sizes: list[int], most: int = BLOCK) -> tuple[list[int], list[int]]:
    """The block of every row of cells, and the parts of every block: neighbours share one up to ``most`` vectors."""
    block, parts, held = [], [], 0
    for n in sizes:
        if not parts or held + n > most:
            parts.append(max(1, -(-n // most)))
            held = 0
        held += n
        block.append(len(parts) - 1)
    return block, parts


def _nearest(top: int, kind: np.dtype):
    """The ``top`` best of each query among a block's vectors in the query's cells; ranks and reaches are numbers of ``kind``."""
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def best(ids: np.ndarray, rows: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray, units: np.ndarray,
             query: np.ndarray, own: np.ndarray, q: np.ndarray, rank: np.ndarray, reach: np.ndarray) -> pa.RecordBatch:
        # In single precision and with lengths of at most 1. Twice the rounding of such a sum, at most, is ``slack``:
        # whatever is that near to the last place is summed exactly as stated below.
        scores = _shortened(q, _norms(q)[:, None]) @ units.T
        slack = np.float32(2 * (x.shape[1] + 4) * np.finfo(np.float32).eps)
        # The last place among every so many vectors is a bound.
        step = max(1, min(8, len(ids) // 1024))
        seen = np.where((rank.take(j[::step], axis=1) < reach.take(i[::step], axis=1)) & (rows[::step] != own[:, None]), scores[:, ::step], np.float32(-np.inf))
        bound = np.partition(seen, -top, axis=1)[:, -top] - slack if seen.shape[1] > top else np.full(len(q), -np.inf, np.float32)
        which, at = np.divmod(np.flatnonzero(~(scores < bound[:, None])), len(ids))
        mine = (rank[which, j[at]] < reach[which, i[at]]) & (rows[at] != own[which])
        which, at = which[mine], at[mine]
        ends, near = np.searchsorted(which, np.arange(len(q) + 1)), np.ones(len(at), bool)
        got = scores[which, at]
        for start, end in zip(ends, ends[1:]):
            if end - start > top:
                near[start:end] = ~(got[start:end] < np.partition(got[start:end], -top)[-top] - slack)
        which, at = which[near], at[near]
        score = np.zeros(len(at))
        for start in range(0, len(at), 16 * POINTS):
            some = slice(start, start + 16 * POINTS)
            # Component by component, so that equal vectors get equal sums wherever they stand.
            for part in np.ascontiguousarray((q[which[some]] * x[at[some]]).T):
                score[some] += part
        order = np.lexsort((ids[at], -score, which))
        order = order[np.arange(len(order)) - np.searchsorted(which, which) < top]
        which, at = which[order], at[order]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (own[which], query[which], ids[at], score[order])], schema=schema)

    def numbers(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vecs, block = None, [], None
        for batch in batches:
            task, ask = batch.column("task").to_numpy(), batch.column("ask").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((task[1:] != task[:-1]) | (ask[1:] != ask[:-1])) + 1).tolist(), len(task)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                some = batch.slice(start, end - start)
                if task[start] != now:
                    now, vecs, block = task[start], [], None
                if not ask[start]:
                    vecs.append(some)
                    continue
                if block is None and vecs:
                    whole = pa.Table.from_batches(vecs)
                    x, vecs = _matrix(whole["v"]), []
                    block = *(whole[c].to_numpy() for c in ("id", "row")), x, *(whole[c].to_numpy() for c in ("i", "j")), _shortened(x, _norms(x).max())
                if block is None:
                    continue
                most = max(1, min(QUERIES, PAIRS // len(block[0])))
                for at in range(0, len(some), most):
                    few = some.slice(at, most)
                    yield best(*block, *(few.column(c).to_numpy() for c in ("id", "row")), _matrix(few.column("v")).astype(float), numbers(few.column("rank")), numbers(few.column("reach")))

    return run


def nearest(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, top: int = 20,
            share: float = SHARE, at_least: int = 4000, centroids: int | None = None, sample: int = 20_000) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each query, ids divisible by ``every``.

    All vectors are indexed. A query's cells hold ``share`` of them and ``at_least`` so many, or all; only its own row is
    no candidate. Ties go to the smaller vec_id. ``usable`` says which vectors take part; without any there are no rows.
    Vectors of different lengths have no inner product: those of each length are searched by themselves.
    """
    good = stored(usable(vectors, vec_id, vector), "vectors")
    found = vectors.sparkSession.createDataFrame([], FOUND)
    for r in good.select(F.size("v").alias("n")).distinct().orderBy("n").collect():
        found = found.unionByName(_of_one_length(good.where(F.size("v") == r.n), every, top, share, at_least, centroids, sample))
    discard(good)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


FOUND = "query_row long, query_id long, vec_id long, score double"


def _of_one_length(good: DataFrame, every: int, top: int, share: float, at_least: int, centroids: int | None, sample: int) -> DataFrame:
    """The best of each query in each block; once this returns, nothing reads ``good`` any more."""
    book = fit_codebook(good, centroids, sample)
    first, second, norm = book.first, book.second, book.norm

    @F.pandas_udf(row_type("i int, j int"))
    def cell(vs: pd.Series) -> pd.DataFrame:
        a, b = Codebook(first, second, norm).halves(np.stack(vs.to_numpy()).astype(float))
        return pd.DataFrame({"i": closest(a, first)[0].astype(np.int32), "j": closest(b, second)[0].astype(np.int32)})

    placed = stored(good.withColumn("cell", cell("v")).select("row", "id", "v", "cell.i", "cell.j"), "cells")
    # At most 1024 x 1024 counts, whatever the number of vectors.
    counts = np.zeros((len(first), len(second)), np.int64)
    held = placed.groupBy("i", "j").agg(F.count("*").alias("n")).toArrow()
    counts[held["i"].to_numpy(), held["j"].to_numpy()] = held["n"].to_numpy()
    n = int(counts.sum())
    enough = max(at_least, int(share * n)) + 1
    whole = max(1, BLOCK * 64 // max(64, first.shape[1] + second.shape[1] - 1))
    most = min(whole, max(LEAST, n // BLOCKS))
    rows, columns = (_bands(counts.sum(at), most) for at in (1, 0))
    held = np.add.reduceat(np.add.reduceat(counts, rows[:-1], 0), columns[:-1], 1)
    # The first task of each block, by number; a block without vectors has none.
    tasks = np.cumsum([0, *np.maximum(-(-held // whole), np.rint(held / most).astype(int).clip(held > 0)).ravel()]).tolist()
    kind = np.min_scalar_type(max(counts.shape))
    number = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at + 1)

    def band(edges: list[int], at: Column) -> Column:
        return number(np.repeat(range(len(edges) - 1), np.diff(edges)).tolist(), at)

    def cut(numbers: Column, edges: list[int], at: Column) -> Column:
        return numbers.substr(number(edges, at) * kind.itemsize + 1, (number(edges, at + 1) - number(edges, at)) * kind.itemsize)

    @F.pandas_udf(row_type("blocks array<int>, rank binary, reach binary"))
    def visit(vs: pd.Series) -> pd.DataFrame:
        h, out = first.shape[1], []
        for at in range(0, len(vs), QUERIES):
            x = np.stack(vs.iloc[at:at + QUERIES].to_numpy()).astype(float)
            d1, d2 = _squares(x[:, :h], first), _squares(np.concatenate([x[:, h:], np.zeros((len(x), 1))], 1), second)
            for rank, reach in (staircase(p, q, counts, enough) for p, q in zip(d1, d2)):
                seen = (np.maximum.reduceat(reach, rows[:-1])[:, None] > np.minimum.reduceat(rank, columns[:-1])) & (held > 0)
                out.append((np.flatnonzero(seen).astype(np.int32), rank.astype(kind).tobytes(), reach.astype(kind).tobytes()))
        return pd.DataFrame(out, columns=["blocks", "rank", "reach"])

    width, block = len(columns) - 1, F.col("block")
    start, end = number(tasks, block), number(tasks, block + 1)
    entries = placed.withColumn("r", band(rows, F.col("i"))).withColumn("c", band(columns, F.col("j"))).withColumn("block", F.col("r") * width + F.col("c")) \
        .select((start + F.pmod(F.xxhash64("row"), (end - start).cast("long")).cast("int")).alias("task"), F.lit(False).alias("ask"),
                "id", "row", "v", (F.col("i") - number(rows, F.col("r"))).alias("i"), (F.col("j") - number(columns, F.col("c"))).alias("j"))
    queries = placed.where(F.col("id") % every == 0).select("id", "row", "v", visit("v").alias("seen")) \
        .select("id", "row", "v", F.explode("seen.blocks").alias("block"), "seen.rank", "seen.reach") \
        .select("id", "row", "v", cut(F.col("rank"), columns, block % width).alias("rank"), cut(F.col("reach"), rows, (block / width).cast("int")).alias("reach"),
                F.explode(F.sequence(start, end - 1)).alias("task"), F.lit(True).alias("ask"))
    meet = entries.unionByName(queries, allowMissingColumns=True).repartitionById(tasks[-1], "task").sortWithinPartitions("task", "ask")
    return meet.mapInArrow(_nearest(top, kind), row_type(FOUND))


def _bands(sizes: np.ndarray, most: int) -> list[int]:
    """Where the rows, or columns, of blocks of about ``most`` vectors begin, and where the last ends."""
    n = int(sizes.sum())
    # The row that would exceed this closes a band, so there are no more bands than blocks along a square's side.
    band = pack(sizes.tolist(), n // math.ceil((n / most) ** 0.5) + int(sizes.max()))[0]
    return [*np.flatnonzero(np.diff([-1, *band])).tolist(), len(sizes)]
