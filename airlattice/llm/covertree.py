"""Hard negatives by a cover tree over norm-augmented candidates.

Every candidate gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and an anchor a zero there. Then
|a' - x'|^2 = |a|^2 + M^2 - 2 a.x, so a ball around a pivot bounds the inner products of all that lies in it: from
below by its far side, from above by its near side.

The tree's top level are pivots picked farthest first from a bounded sample; every row belongs to the nearest one, and
the pivot's covering radius is taken over all its rows. A pivot's rows, dealt into parts of about ``PART`` where there
are more, become one tree each: a node's children are points of it, again picked farthest first until they cover the
node within ``SHRINK`` of its radius (or ``FAN`` of them, then with the radius they reach), down to leaves of ``LEAF``.

A search descends best first. Nodes whose bounds lie outside all windows are skipped, a window is closed when no node
left can beat what it has, and leaves are verified on exact integers. Positives are searched first in the anchor's own
part of the top level, which gives a score to beat, then in all others whose bound beats it; negatives in all trees
whose bounds meet a window. Nothing is approximate: bounds are widened by more than the rounding of the radii.

Defined results: rows whose label or vector is null, or that have a null or non-finite component, take no part. Vectors
are compared with those of the same length only. A row without id is no anchor and comes last among equal scores; rows
that share an id are rows of their own, each an anchor where the id is one, and an anchor leaves out only its own row.
No rows give no result. Scores that exceed a long are stated as the nearest long. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from airlattice.llm.common import col, row_type, stored

PART, LEAF, FAN, SHRINK = 4096, 128, 32, 0.75
#: Rows from which the top pivots are picked, and how many pivots there are at most.
SAMPLE, PIVOTS = 4096, 256
#: Share of the squared norms by which bounds are widened. A distance is off by at most some 1e-7 of the norms.
SLACK = 1e-5
LONG = np.iinfo(np.int64)


def scaled(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", relabel_every: int = 7,
           labels: int = 10, scale: int = 256) -> DataFrame:
    """(row, id, label, v): rows that take part, labels changed where the id is divisible by ``relabel_every``, floors of ``scale`` * x."""
    doubles = col(vector).cast(T.ArrayType(T.DoubleType()))
    df = vectors.select(col(vec_id).cast("long").alias("id"), col(label).cast("long").alias("label"), doubles.alias("v")).where(
        "label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
    moved = F.coalesce(F.col("id") % relabel_every == 0, F.lit(False))
    # rint(y) - (rint(y) > y) is the floor of a double as a double, whatever its size.
    whole = F.transform("v", lambda x: F.rint(x * scale) - F.when(F.rint(x * scale) > x * scale, 1.0).otherwise(0.0))
    return df.select(F.monotonically_increasing_id().alias("row"), "id", F.when(moved, (F.col("label") + 1) % labels).otherwise(F.col("label")).alias("label"),
                     whole.alias("v"))


def lift(x: np.ndarray, norm: float) -> np.ndarray:
    """Candidates with their norm component."""
    return np.concatenate([x, np.sqrt(np.maximum(norm - (x * x).sum(1), 0.0))[:, None]], 1)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows x to rows c."""
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0.0))


def net(x: np.ndarray, first: int, most: int, within: float) -> tuple[list[int], np.ndarray]:
    """Points picked farthest first until every point is ``within`` of one, or there are ``most``; the nearest of each point."""
    picked, own = [first], np.zeros(len(x), np.int64)
    near = distances(x, x[[first]])[:, 0]
    while len(picked) < most:
        far = int(near.argmax())
        if near[far] <= within or near[far] == 0:
            break
        d = distances(x, x[[far]])[:, 0]
        closer = d < near
        own[closer], near = len(picked), np.minimum(near, d)
        own[far] = len(picked)
        picked.append(far)
    return picked, own


def build(ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, x: np.ndarray, norm: float) -> dict:
    """A tree as arrays: pivots, radii, children of inner nodes, stretches of points of leaves. ``x`` are whole numbers as doubles.

    Points come in the order of ids, nulls last, which is the order of ties, and are kept as ``place``. They are stored
    leaf by leaf, so a leaf is a slice.
    """
    up = lift(x, norm)
    pivots, radii, below, leaves = [], [], [], []
    todo = [(np.arange(len(x)), 0, -1)]
    while todo:
        points, pivot, parent = todo.pop()
        d = distances(up[points], up[[pivot]])[:, 0]
        node, radius = len(pivots), float(d.max())
        pivots.append(pivot)
        radii.append(radius)
        below.append([])
        leaves.append(None)
        if parent >= 0:
            below[parent].append(node)
        first = int(np.flatnonzero(points == pivot)[0])
        split = len(points) > LEAF and 0 < radius < np.inf
        picked, own = net(up[points], first, min(FAN, -(-len(points) // LEAF)), SHRINK * radius) if split else ([first], None)
        if len(picked) == 1:
            leaves[node] = np.sort(points)
        else:
            todo += [(points[own == k], int(points[p]), node) for k, p in enumerate(picked)]
    held = [leaf for leaf in leaves if leaf is not None]
    order, ends = np.concatenate(held), np.cumsum([0] + [len(leaf) for leaf in held]).tolist()
    spans = iter(zip(ends, ends[1:]))
    return {"ids": ids[order], "rows": rows[order], "labels": labels[order], "x": x[order], "place": order, "pivots": up[pivots],
            "radii": np.array(radii), "below": below, "leaves": [None if leaf is None else next(spans) for leaf in leaves], "most": float(np.abs(x).max(initial=0))}


def product_of(tree: dict, a: np.ndarray):
    """A function of rows of the tree to their exact inner products: doubles where none can round, else Python integers."""
    most = max(tree["most"], 1.0) * max(float(np.abs(a).max(initial=0)), 1.0) * max(len(a), 1)
    if most < 2.0**53:
        return lambda x: x @ a
    whole = [int(v) for v in a]
    return lambda x: np.array([min(max(sum(int(u) * v for u, v in zip(r, whole)), LONG.min), LONG.max) for r in x], object)


def bounds(square: float, near: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product with points within ``radii`` of pivots at the distances ``near``."""
    slack = SLACK * square + 1e-6
    lower, upper = (square - (near + radii) ** 2) / 2 - slack, (square - np.maximum(near - radii, 0.0) ** 2) / 2 + slack
    return np.where(np.isfinite(lower), lower, -np.inf), np.where(np.isfinite(upper), upper, np.inf)


def best_first(tree: dict, ask: dict, top: int, norm: float, near: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(score, place, point) of the ``top`` best points of each window of the anchor; ``near``: its distances to the pivots.

    ``ask``: row, label, v, same (wanted labels are the anchor's, or all others), windows (lowest, highest score).
    """
    a, windows, product = ask["v"], ask["windows"], product_of(tree, ask["v"])
    lower, upper = bounds(float(a @ a) + norm, near, tree["radii"])
    found: list[list[tuple[int, int, int]]] = [[] for _ in windows]
    span = [(float(lo), float(hi)) for lo, hi in windows]
    heap = [(-upper[0], 0)]
    while heap:
        best, node = heapq.heappop(heap)
        ahead = [w for w, (lo, hi) in enumerate(span) if -best >= lo and lower[node] <= hi and not (len(found[w]) == top and found[w][-1][0] > -best)]
        if not ahead:
            continue
        if tree["leaves"][node] is None:
            for child in tree["below"][node]:
                heapq.heappush(heap, (-upper[child], child))
            continue
        at, end = tree["leaves"][node]
        scores = product(tree["x"][at:end])
        fits = ((tree["labels"][at:end] == ask["label"]) == ask["same"]) & (tree["rows"][at:end] != ask["row"])
        floors = [max(windows[w][0], found[w][-1][0]) if len(found[w]) == top else windows[w][0] for w in ahead]
        hits = np.flatnonzero(fits & (scores >= min(floors)) & (scores <= max(windows[w][1] for w in ahead)))
        if not len(hits):
            continue
        new = [(int(scores[k]), int(tree["place"][at + k]), at + int(k)) for k in hits]
        for w, lo in zip(ahead, floors):
            more = [f for f in new if lo <= f[0] <= windows[w][1]]
            if more:
                found[w] = sorted(found[w] + more, key=lambda f: (-f[0], f[1]))[:top]
    return found


def _lists(column: pa.Array) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    return np.split(column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]], ends[1:-1] - ends[0])


def _plant(norm: float):
    """Sorted rows (n, pivot, part, row, id, label, v) to one pickled tree for each (n, pivot, part)."""
    schema = pa.schema([("n", pa.int32()), ("pivot", pa.int32()), ("part", pa.int32()), ("tree", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def grown() -> pa.RecordBatch:
            rows, ids, labels, vs = zip(*held)
            x = np.array(vs, float).reshape(len(vs), now[0])
            tree = build(np.array(ids, object), np.array(rows, np.int64), np.array(labels, np.int64), x, norm)
            small = tree["x"].astype(np.float32)
            tree["x"] = small if np.array_equal(small, tree["x"]) else tree["x"]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, pickle.dumps(tree)), schema)], schema=schema)

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
            rows = zip(*(batch.column(k).to_pylist() for k in range(3, 6)), _lists(batch.column(6)))
            for key, row in zip(keys, rows):
                if key != now:
                    if held:
                        yield grown()
                    now, held = key, []
                held.append(row)
        if held:
            yield grown()

    return run


def _descend(same: bool, top: int, norm: float, asks_at_once: int = 256):
    """Trees and the anchors that ask them, sorted by (n, pivot, part, tree first), to what is found for each window."""
    schema = pa.schema([("row", pa.int64()), ("w", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, asks = None, []

        def answer() -> pa.RecordBatch:
            a = np.array([r["v"] for r in asks])
            near, out = distances(np.concatenate([a, np.zeros((len(a), 1))], 1), tree["pivots"]), []
            for ask, d in zip(asks, near):
                for w, got in zip(ask["numbers"], best_first(tree, ask, top, norm, d)):
                    out += [(ask["row"], w, tree["ids"][point], score) for score, _, point in got]
            asks.clear()
            columns = zip(*out) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            blobs, rows, labels, windows = (batch.column(k).to_pylist() for k in range(4))
            for blob, row, label, ws, v in zip(blobs, rows, labels, windows, _lists(batch.column(4))):
                if blob is not None:
                    if asks:
                        yield answer()
                    tree = pickle.loads(blob)
                    tree["x"] = tree["x"].astype(float)
                    continue
                asks.append({"row": row, "label": label, "same": same, "v": v, "windows": [(w["lo"], w["hi"]) for w in ws], "numbers": [w["w"] for w in ws]})
                if len(asks) >= asks_at_once:
                    yield answer()
        if asks:
            yield answer()

    return run


WINDOWS = "array<struct<w: int, lo: long, hi: long>>"


def mine_negatives(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100,
                   positives: int = 5, negatives: int = 5, least: tuple[int, int] = (4, 5), sample: int = SAMPLE, **scaling) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. A negative's score lies between the fraction ``least`` of
    the positive's score and that score. What reaches the driver: ``sample`` vectors, and a row for each top pivot.
    """
    spark = vectors.sparkSession
    data = stored(scaled(vectors, vec_id, vector, label, **scaling), "scaled")
    count, norm = data.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    norm = float(norm)
    picked: dict[int, list[np.ndarray]] = {}
    for r in data.orderBy(F.xxhash64("row"), "row").limit(sample).select("v").collect():
        picked.setdefault(len(r.v), []).append(np.array(r.v, float))
    most, pivots = min(PIVOTS, -(-count // PART)), {}
    for n, vs in picked.items():
        up = lift(np.array(vs).reshape(len(vs), n), norm)
        pivots[n] = up[net(up, 0, most, 0.0)[0] if np.isfinite(norm) else [0]]

    @F.pandas_udf(row_type("pivot int, far double"))
    def nearest_pivot(vs):
        import pandas as pd
        out = pd.DataFrame({"pivot": np.full(len(vs), -1, np.int32), "far": np.zeros(len(vs))})
        sizes = vs.map(len).to_numpy()
        for n in np.unique(sizes):
            if n in pivots:
                at = np.flatnonzero(sizes == n)
                d = distances(lift(np.array(vs.iloc[at].tolist(), float).reshape(len(at), n), norm), pivots[n])
                out.loc[at, "pivot"], out.loc[at, "far"] = d.argmin(1).astype(np.int32), d.min(1)
        return out

    owned = stored(data.withColumn("own", nearest_pivot("v")).select("row", "id", "label", "v", F.size("v").alias("n"), "own.pivot", "own.far"), "owned")
    parts = stored(owned.groupBy("n", "pivot").agg(F.count("*").alias("held"), F.max("far").alias("radius"))
                   .withColumn("parts", F.ceil(F.col("held") / PART).cast("int")), "pivots")
    held = {(r.n, r.pivot): r.radius if r.pivot >= 0 and np.isfinite(norm) else np.inf for r in parts.collect()}
    # One row for each pivot: at most PIVOTS for each length of vectors.
    parts = F.broadcast(parts.select("n", "pivot", "parts"))
    dealt = owned.join(parts, ["n", "pivot"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts").cast("long")).cast("int"))
    group = ["n", "pivot", "part"]
    trees = stored(dealt.select(*group, "row", "id", "label", "v").repartition(*group).sortWithinPartitions(*group, F.asc_nulls_last("id"), "row")
                   .mapInArrow(_plant(norm), row_type("n int, pivot int, part int, tree binary")), "trees")

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def reachable(vs, own, lows, highs):
        """Pivots whose bounds meet the scores from low to high, but for ``own``."""
        import pandas as pd
        out = []
        for v, not_this, low, high in zip(vs, own, lows, highs):
            n, v = len(v), np.array(v, float)
            mine = [p for m, p in held if m == n and p != not_this]
            known = [p for p in mine if p >= 0]
            near = distances(np.append(v, 0.0)[None, :], pivots[n][known])[0] if known else np.zeros(0)
            lower, upper = bounds(float(v @ v) + norm, near, np.array([held[n, p] for p in known]))
            out.append([p for p in mine if p < 0] + [p for p, lo, up in zip(known, lower, upper) if up >= low and lo <= high])
        return pd.Series(out, dtype=object)

    def search(asks: DataFrame, same: bool, top: int) -> DataFrame:
        """(row, w, id, score) of asks (n, pivot, row, label, windows, v), which go to all parts of their pivot."""
        spread = asks.join(parts, ["n", "pivot"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        spread = spread.select(*group, F.lit(None).cast("binary").alias("tree"), "row", "label", "windows", "v")
        none = F.array().cast("array<double>")
        meet = trees.select(*group, "tree", *[F.lit(None).cast("long").alias(c) for c in ("row", "label")], F.lit(None).cast(WINDOWS).alias("windows"),
                            none.alias("v")).unionByName(spread)
        meet = meet.repartition(*group).sortWithinPartitions(*group, F.desc_nulls_last(F.col("tree").isNotNull()))
        return meet.select("tree", "row", "label", "windows", "v").mapInArrow(_descend(same, top, norm), row_type("row long, w int, id long, score long"))

    def best(found: DataFrame, keys: list[str], top: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def window(low, high):
        return F.array(F.struct(F.lit(0).alias("w"), low.cast("long").alias("lo"), high.cast("long").alias("hi"))).cast(WINDOWS)

    lowest, highest = F.lit(int(LONG.min)), F.lit(int(LONG.max))
    anchors = owned.where(F.col("id") % every == 0).drop("far")
    near = stored(best(search(anchors.withColumn("windows", window(lowest, highest)), True, positives), ["row"], positives), "near")
    beaten = near.where(F.col("rank") == positives).select("row", F.col("score").alias("low"))
    others = anchors.join(beaten, "row", "left").withColumn("low", F.coalesce("low", lowest))
    others = (others.withColumn("pivot", F.explode(reachable("v", "pivot", F.col("low").cast("double"), F.lit(np.inf))))
              .withColumn("windows", window(F.col("low"), highest)))
    good = stored(best(near.drop("rank").unionByName(search(others, True, positives)), ["row"], positives), "positives")

    up, down = least
    low = F.ceil(F.col("score").cast("decimal(19,0)") * up / down).cast("long")
    wanted = good.groupBy("row").agg(F.collect_list(F.struct(F.col("rank").cast("int").alias("w"), low.alias("lo"), F.col("score").alias("hi"))).cast(WINDOWS).alias("windows"))
    asks = anchors.drop("pivot").join(wanted.withColumn("windows", F.filter("windows", lambda w: w.lo <= w.hi)), "row").where(F.size("windows") > 0)
    ends = lambda f, c: f(F.transform("windows", lambda w: w[c])).cast("double")
    asks = asks.withColumn("pivot", F.explode(reachable("v", F.lit(-2), ends(F.array_min, "lo"), ends(F.array_max, "hi"))))
    met = best(search(asks, False, negatives), ["row", "w"], negatives)
    chosen = good.select("row", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (met.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(chosen, ["row", "w"])
            .join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
