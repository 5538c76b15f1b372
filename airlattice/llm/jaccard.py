"""N-gram Jaccard join: MinHash bands find candidate pairs, full n-gram sets verify them.

Texts with one and the same n-gram set form a class and are handled once. A class is hashed into ``BANDS``
bands of ``ROWS`` minima; classes that share a band hash meet in its bucket. Buckets with equal members count
once, large ones are dealt out in blocks of bounded size, and a pair is verified only in the first band that
its classes share. No pair is ever a row: a block returns, for each class in it, the number of its links and
the smallest class of its linked group, from which connected groups are built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlattice.llm.common import col, fresh, row_key, row_type, stored, whole_row_key, words

N = 5
SIMILARITY = 0.8
#: A pair at similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 0.999997 at 0.8, 0.05 at 0.2.
ROWS, BANDS = 4, 24
#: Classes, and n-grams, of a block on average.
BLOCK_CLASSES, BLOCK_GRAMS = 512, 400_000
_odd = np.random.default_rng(20240501).integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def grams(text: str | None, n: int = N) -> np.ndarray:
    """Sorted different 64-bit hashes of the word n-grams; a shorter text with words is one gram, none gives none."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    a = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    m = min(n, len(a))
    s = np.full(len(a) - m + 1, m, np.uint64)
    for k in range(m):
        s = s * np.uint64(0x9E3779B97F4A7C15) + a[k:len(a) - m + 1 + k]
    return np.unique(_mixed(s))


def bands(g: np.ndarray) -> np.ndarray:
    """One hash per band: the minima of ROWS multiplicative permutations, mixed together."""
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(g), 2048):
        np.minimum(low, (g[None, at:at + 2048] * _odd[:, None]).min(1), out=low)
    low = low.reshape(BANDS, ROWS)
    out = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        out = _mixed(out + low[:, k])
    return out


SIGNED = row_type("key binary, n long, bands array<long>")


@F.pandas_udf(SIGNED)
def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for t in texts:
            g = grams(t)
            rows.append((xxhash.xxh3_128_digest(g.tobytes()), len(g), bands(g).view(np.int64)) if len(g) else (None, 0, None))
        yield pd.DataFrame(rows, columns=["key", "n", "bands"])


@F.pandas_udf(row_type("key binary, grams binary"))
def gram_set(texts: pd.Series) -> pd.DataFrame:
    sets = [grams(t).tobytes() for t in texts]
    return pd.DataFrame({"key": [xxhash.xxh3_128_digest(s) for s in sets], "grams": sets})


class Group:
    """Classes of one block of a bucket, in two sides; the sides of a diagonal block are equal."""

    def __init__(self, rows: list[tuple]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.weight = np.array([r[1] for r in rows], np.int64)
        self.bands = np.array([r[2] for r in rows], np.int64).reshape(len(rows), BANDS)
        self.sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)


def verify(a: Group, b: Group, same: bool, band: int, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each class of ``a`` with links: its place and the places of its links in ``b``.

    Only pairs whose first shared band is ``band``, and of one block the ones above the diagonal.
    """
    all_b = np.concatenate(b.sets) if b.sets else np.zeros(0, np.uint64)
    ends = np.cumsum(b.sizes)
    starts = ends - b.sizes
    for k in range(len(a.ids)):
        small, large = np.minimum(a.sizes[k], b.sizes), np.maximum(a.sizes[k], b.sizes)
        open_ = small >= least * large
        if same:
            open_[:k + 1] = False
        if band and open_.any():
            where = np.flatnonzero(open_)
            open_[where] = ~(b.bands[where, :band] == a.bands[k, :band]).any(1)
        where = np.flatnonzero(open_)
        if not len(where):
            continue
        if len(where) < len(b.ids) // 4:
            both = np.array([len(np.intersect1d(a.sets[k], b.sets[j], assume_unique=True)) for j in where])
        else:
            at = np.searchsorted(a.sets[k], all_b)
            at[at == len(a.sets[k])] = 0
            hits = np.concatenate([[0], np.cumsum(a.sets[k][at] == all_b)])
            both = (hits[ends] - hits[starts])[where]
        linked = where[both >= least * (a.sizes[k] + b.sizes[where] - both) - 1e-9]
        if len(linked):
            yield k, linked


LINKED = "id long, root long, links long"


def _linked(rows: list[tuple], band: int, left: int, right: int, least: float) -> Iterator[tuple[int, int, int]]:
    """Links and smallest linked class of every class of a block pair that has a link."""
    a = Group([r for r in rows if r[4] == left])
    b = a if left == right else Group([r for r in rows if r[4] == right])
    ids = a.ids if a is b else np.concatenate([a.ids, b.ids])
    parent, links = list(range(len(ids))), [0] * len(ids)
    shift = 0 if a is b else len(a.ids)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, others in verify(a, b, a is b, band, least):
        links[k] += int(b.weight[others].sum())
        for j in others:
            links[j + shift] += int(a.weight[k])
            x, y = root(k), root(j + shift)
            if x != y:
                if ids[x] > ids[y]:
                    x, y = y, x
                parent[y] = x
    for k, n in enumerate(links):
        if n:
            yield int(ids[k]), int(ids[root(k)]), n


def _verify_blocks(least: float):
    schema = pa.schema([("id", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(key, rows):
            found = list(_linked(rows, key[0], key[2], key[3], least))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], schema=schema) if found else None

        now, rows = None, []
        for batch in batches:
            cols = [batch.column(k) for k in range(batch.num_columns)]
            bands_ = cols[6].flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
            keys = list(zip(*(c.to_pylist() for c in cols[:4])))
            ids, weights, sets, sides = cols[4].to_pylist(), cols[5].to_pylist(), cols[7].to_pylist(), cols[8].to_pylist()
            for k, key in enumerate(keys):
                if key != now:
                    if len(rows) > 1 and (out := done(now, rows)):
                        yield out
                    now, rows = key, []
                rows.append((ids[k], weights[k], bands_[k], sets[k], sides[k]))
        if len(rows) > 1 and (out := done(now, rows)):
            yield out

    return run


def connected(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id of each connected group, from edges (a, b) between ids.

    Large-star and small-star steps in turn; each is stored in the shared folder, so lineage stays short, and the
    groups are done when a step changes nothing. Hot ids are pre-aggregated before the shuffle.
    """
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(low, "a")
        if small:
            out = out.select(F.col("b").alias("x"), "m").unionByName(low.select(F.col("a").alias("x"), "m"))
        else:
            out = out.where("b > a").select(F.col("b").alias("x"), "m")
        return out.where("x <> m").distinct().select(F.col("x").alias("a"), F.col("m").alias("b"))

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r.n, r.h

    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = mark(now)
    while before[0]:
        now = stored(star(now, small=False), "edges")
        now = stored(star(now, small=True), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))


def _id_and_text(doc_id: str, text: str) -> Column:
    return row_key({"id": col(doc_id).cast("long"), "text": col(text)}, {"id": "bigint", "text": "string"})


def join_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, text_class, n_grams; for ``keep_one_each`` also row and root.

    ``class_id`` is the smallest doc_id of the connected group of texts at similarity ``least`` or more, ``text_class``
    the smallest doc_id with the same n-gram set. ``n_links`` counts the other rows at that similarity, copies
    included. Rows with one doc_id and equal sets are copies of each other like any two rows. Texts without a word
    (null, empty, blank) link to nothing: class_id and text_class are their doc_id. A null doc_id counts as the
    smallest and gives null classes. An empty table gives no rows. ``row`` is a key of doc_id and text; ``root`` is a
    number of the group, null without a word. Groups that share their smallest doc_id differ in it.
    """
    signed = stored(docs.select(col(doc_id).cast("long").alias("doc_id"), _id_and_text(doc_id, text).alias("row"), sign(col(text)).alias("s"))
                    .select("doc_id", "row", "s.key", "s.n", "s.bands"), "signed")
    lowest = F.lit(-(2**63)).cast("long")
    of = F.coalesce("doc_id", lowest)
    classes = signed.where("n > 0").groupBy("key").agg(F.min(of).alias("first"), F.count("*").alias("weight"))
    # Classes are numbered by their smallest doc_id; where two share one (rows with equal ids), by the key as well.
    classes = stored(classes.withColumn("id", F.col("first")), "classes")
    twice = classes.groupBy("id").agg(F.count("*").alias("c")).where("c > 1")
    if not twice.isEmpty():
        classes = stored(classes.withColumn("id", F.xxhash64("key")), "classes")
    hashed = signed.where("n > 0").groupBy("key").agg(F.first("bands").alias("bands"), F.first("n").alias("n"))
    hashed = stored(hashed.join(classes, "key").select("id", "weight", "n", "bands"), "hashed")

    # Buckets with two members or more; of those with equal members the one of the lowest band.
    member = hashed.select("id", "n", F.posexplode("bands").alias("band", "h"))
    alike = F.xxhash64("id")
    buckets = member.groupBy("band", "h").agg(
        F.count("*").alias("size"), F.sum("n").alias("grams"), F.bit_xor(alike).alias("x"),
        F.sum(F.shiftright(alike, 20)).alias("y")).where("size > 1")
    kept = buckets.groupBy("size", "x", "y").agg(F.min("band").alias("band"), F.min_by("h", "band").alias("h"), F.first("grams").alias("grams"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_CLASSES, F.col("grams") / BLOCK_GRAMS)).cast("int")
    kept = stored(kept.select("band", "h", blocks.alias("blocks")), "buckets")
    place = stored(member.join(kept, ["band", "h"]).select(
        "id", "band", "h", "blocks", F.pmod(F.xxhash64("id", F.lit(7)), "blocks").cast("int").alias("side")), "places")

    # N-gram sets only of classes that meet another one, from one document of the class each.
    needed = place.select("id").distinct().join(hashed.select("id", "weight", "bands"), "id")
    carrier = signed.join(classes.select("key", "id", "first"), "key").where(of == F.col("first")) \
        .join(needed.select("id"), "id", "left_semi").groupBy("id").agg(F.min("row").alias("carrier"), F.first("key").alias("key"))
    # By the key of id and text: rows without an id, or with one id, would else meet every class of theirs.
    texts = docs.select(_id_and_text(doc_id, text).alias("carrier"), col(text).alias("t"))
    # Compared only when the join is done: as a join condition the sets of all texts would be made for it.
    sets = texts.join(carrier, "carrier").select("id", "key", gram_set("t").alias("s")) \
        .groupBy("id").agg(F.first(F.when(F.col("s.key") == F.col("key"), F.col("s.grams")), ignorenulls=True).alias("grams"))
    full = stored(sets.join(needed, "id"), "sets")

    # Each block pair of a bucket once: a member goes to the pairs that its block is part of.
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda o: F.struct(F.least("side", o).alias("l"), F.greatest("side", o).alias("r")))
    dealt = place.withColumn("p", F.explode(pairs)).join(full, "id").select(
        "band", "h", F.col("p.l").alias("l"), F.col("p.r").alias("r"), "id", "weight", "bands", "grams", "side")
    dealt = dealt.repartition("band", "h", "l", "r").sortWithinPartitions("band", "h", "l", "r")
    found = stored(dealt.mapInArrow(_verify_blocks(least), row_type(LINKED)), "linked")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_class = classes.join(links, "id", "left").join(groups, "id", "left") \
        .select("key", "id", "first", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root"))
    # The smallest doc_id of a group is that of its root, unless classes are numbered by key.
    group_first = by_class.groupBy("root").agg(F.min("first").alias("class_first"))
    by_class = by_class.join(group_first, "root")
    shown = lambda c: F.when(F.col(c) != lowest, F.col(c))
    out = signed.join(by_class, "key", "left")
    lone = F.col("first").isNull()
    return out.select(
        "doc_id", F.when(lone, F.col("doc_id")).otherwise(shown("class_first")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).alias("n_links"),
        F.when(lone, F.col("doc_id")).otherwise(shown("first")).alias("text_class"), F.col("n").alias("n_grams"),
        "row", "root")


def keep_one_each(docs: DataFrame, joined: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with the columns it has: one with the group's smallest doc_id, null counting as the smallest.

    Of several such rows the one with the most n-grams stays, then the one of the smallest key. Groups are told apart
    by their texts, so rows that share a doc_id, or have none, all stay if no other is like them. Rows without a word
    stay all. Copies of a row meet pre-aggregated.
    """
    key, kept_key, whole = fresh(docs, "row_key", "kept_key", "whole_row")
    lowest = F.lit(-(2**63)).cast("long")
    best = F.min(F.struct(F.coalesce("doc_id", lowest).alias("id"), (-F.col("n_grams")).alias("n"), "row"))
    kept = joined.where("n_grams > 0").groupBy("root").agg(best.alias("best")).select(F.col("best.row").alias(kept_key))
    has_word = F.coalesce(col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = docs.where(has_word).groupBy(_id_and_text(doc_id, text).alias(key)) \
        .agg(F.min_by(F.struct(*[col(c) for c in docs.columns]), whole_row_key(docs)).alias(whole))
    one = one.join(kept, F.col(key) == F.col(kept_key), "left_semi").select(f"{whole}.*")
    return one.unionByName(docs.where(~has_word))
