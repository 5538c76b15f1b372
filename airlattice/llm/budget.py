"""Mixing sources to target weights: subset sums over document lengths fill each source's word budget.

Every document is taken ``base`` times; the remaining words of the budget come from a subset. Documents
are counted by exact length, each length first gives its proportional share, and bounded-knapsack dynamic
programming over the counts left picks the lengths that fill the rest. Which documents of a length are
taken follows from a seeded hash, by counting hash ranges, so no length is ever sorted as one group.
"""

from __future__ import annotations

from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airlattice.llm.common import WORD, col, fresh, stored, whole_row_key

WEIGHTS = (5.0, 2.0, 1.0)
MOST_TIMES = 3
#: Hash ranges in which the documents of one source and length are counted.
RANGES = 4096
#: Words of the remaining budget that the dynamic program covers, at least this many.
TABLE_WORDS = 1 << 16


def targets(sizes: list[int], weights: list[float], most: float = MOST_TIMES) -> list[float]:
    """Shares of the whole by weight; what exceeds ``most`` times a source goes to the others by weight, again and again."""
    left, open_, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        whole = sum(weights[k] for k in open_)
        share = {k: left * weights[k] / whole for k in open_}
        over = [k for k in open_ if share[k] > most * sizes[k]]
        if not over:
            for k in open_:
                out[k] = share[k]
            break
        for k in over:
            out[k] = float(most * sizes[k])
            left -= out[k]
            open_.remove(k)
    return out


def fill(budget: int, lengths: list[int], counts: list[int]) -> list[int]:
    """How many documents of each length make the largest sum up to ``budget``: exact bounded knapsack.

    Reachable sums are the bits of an integer; a count splits into powers of two. The lengths are in
    descending order, the walk back uses as few of a part as it can. It needs the sums before each part: one in
    sqrt(parts) is kept, those between are made again, so memory is that of 2 sqrt(parts) integers of ``budget`` bits.
    Parts after the one that reaches ``budget`` itself are not needed.
    """
    full = (1 << (budget + 1)) - 1
    parts = []
    for k, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        count, part = min(count, budget // length if length else 0), 1
        while count > 0:
            part = min(part, count)
            parts.append((k, part))
            count -= part
            part *= 2
    gap = max(1, isqrt(len(parts)))
    reach, kept, used = 1, [], 0
    while used < len(parts) and reach.bit_length() <= budget:
        if used % gap == 0:
            kept.append(reach)
        k, part = parts[used]
        reach = (reach | reach << part * lengths[k]) & full
        used += 1
    at, take = reach.bit_length() - 1, [0] * len(lengths)
    for n in range(len(kept) - 1, -1, -1):
        block, before = parts[n * gap:min((n + 1) * gap, used)], [kept[n]]
        for k, part in block[:-1]:
            before.append((before[-1] | before[-1] << part * lengths[k]) & full)
        for (k, part), sums in zip(reversed(block), reversed(before)):
            if not sums >> at & 1:
                at -= part * lengths[k]
                take[k] += part
    return take


def choose(budget: int, lengths: list[int], counts: list[int], table_words: int = TABLE_WORDS) -> list[int]:
    """Documents to take of each length so that their words come as near ``budget`` as the counts allow, never above.

    Lengths give floor(share * count) first. Longest first, what still surely fits is added until the rest
    is small enough for the table; the table then decides exactly.
    """
    whole = sum(n * c for n, c in zip(lengths, counts, strict=True))
    budget = max(0, min(budget, whole))
    if not whole:
        return [0] * len(lengths)
    take = [c * budget // whole for c in counts]
    rest = budget - sum(n * t for n, t in zip(lengths, take, strict=True))
    order = sorted((k for k in range(len(lengths)) if lengths[k]), key=lambda k: -lengths[k])
    room = max(table_words, 2 * lengths[order[0]])
    for k in order:
        if rest <= room:
            break
        more = min(counts[k] - take[k], max(0, rest - room // 2) // lengths[k])
        take[k] += more
        rest -= more * lengths[k]
    rest_now = min(rest, sum(lengths[k] * (counts[k] - take[k]) for k in order))
    for k, more in zip(order, fill(rest_now, [lengths[k] for k in order], [counts[k] - take[k] for k in order]), strict=True):
        take[k] += more
    return take


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _choose_lengths(one: pd.DataFrame) -> pd.DataFrame:
    one = one.sort_values("size", ascending=False)
    base = int(one["base"].iloc[0])
    take = choose(int(one["budget"].iloc[0]), one["size"].tolist(), one["n"].tolist())
    return pd.DataFrame({"source_no": one["source_no"], "size": one["size"], "base": base, "extra": take})


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """From rows (source, size): the sources' targets, and the takes by source and length.

    Only one row per source reaches the driver. A source's lengths (one row for each different length)
    are decided in one task.
    """
    spark = sized.sparkSession
    by_length = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r.source_size) for r in totals]
    wanted = targets(sizes, [weights[k % len(weights)] for k in range(len(sizes))])
    rows = []
    for k, (r, size, target) in enumerate(zip(totals, sizes, wanted, strict=True)):
        base = min(int(target // size), MOST_TIMES) if size else 0
        rows.append((r.source, k, size, target, base, round(target) - base * size if base < MOST_TIMES else 0))
    sources = spark.createDataFrame(
        rows, "source string, source_no int, source_size long, target double, base int, budget long")
    takes = by_length.join(sources, by_length.source.eqNullSafe(sources.source)) \
        .select("source_no", "size", "n", "base", "budget") \
        .groupBy("source_no").applyInPandas(_choose_lengths, "source_no int, size long, base int, extra long")
    return sources, takes


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[float, ...] = WEIGHTS, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times (0 to 3), taken (size * times), and row,
    the key of all its columns by which ``apply_mix`` finds it.

    Null text has size 0; documents of size 0 are taken ``base`` times like their source. Null is a source
    of its own, last in order. Ties of the seeded hash fall to the smaller doc_id (null first), then to the smaller
    key. Without a doc_id the key is hashed in its place. Reruns take the same documents.
    """
    sized = stored(docs.select(
        col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"), n_words(col(text)).alias("size"),
        whole_row_key(docs).alias("row"))
        .withColumn("h", F.xxhash64(F.lit(seed), F.when(F.col("doc_id").isNull(), F.col("row")), "doc_id", "size")), "sized")
    sources, takes = plan_mix(sized, weights)
    takes = stored(takes, "takes")
    numbered = sized.join(sources, sized.source.eqNullSafe(sources.source)) \
        .select(sized["*"], "source_no", "source_size", "target", F.pmod("h", F.lit(RANGES)).cast("int").alias("r"))
    keys = ["source_no", "size"]
    partial = takes.where("extra > 0")
    ahead = Window.partitionBy(*keys).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = numbered.join(partial, keys).groupBy(*keys, "r").agg(F.count("*").alias("n"), F.max("extra").alias("extra")) \
        .withColumn("room", F.col("extra") - F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    # A range lies wholly inside, wholly outside, or is the one of its length where the take ends.
    ranges = ranges.select(*keys, "r", "n", "room")
    out = numbered.join(takes.select(*keys, "base"), keys).join(ranges, [*keys, "r"], "left") \
        .withColumn("room", F.coalesce("room", F.lit(0)))
    edge = F.col("room").between(1, F.col("n") - 1)
    # Only documents of such edge ranges are ranked: n / RANGES of a length.
    place = F.row_number().over(Window.partitionBy(*keys, "r").orderBy("h", "doc_id", "row"))
    plain, ranked = out.where(~F.coalesce(edge, F.lit(False))), out.where(edge)
    picked = plain.withColumn("more", F.when(F.col("room") >= F.col("n"), 1).otherwise(0)).unionByName(
        ranked.withColumn("more", F.when(place <= F.col("room"), 1).otherwise(0)))
    times = F.coalesce(F.col("base"), F.lit(0)) + F.col("more")
    return picked.select("doc_id", "source", "size", "source_size", "target", times.cast("int").alias("times"),
                         (F.col("size") * times).cast("long").alias("taken"), "row")


def apply_mix(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns they have.

    ``mix`` is that of the same rows, joined by the key of all their columns. Rows equal throughout are taken as often
    as their takes add up to: each the same number of times, what is left over from one of them.
    """
    name, mix_key, times, over, key = fresh(docs, "copy", "mix_key", "mix_times", "mix_over", "row_key")
    n, whole = F.count("*"), F.sum("times")
    per_row = stored(mix.groupBy(F.col("row").alias(mix_key)).agg(
        F.floor(whole / n).cast("int").alias(times), (whole % n).cast("int").alias(over)), "row-takes")

    def taken(rows: DataFrame, number: str) -> DataFrame:
        return rows.join(per_row.where(F.col(number) > 0), F.col(key) == F.col(mix_key)) \
            .withColumn(name, F.explode(F.array_repeat(F.lit(1), F.col(number)))) \
            .select(*[col(c) for c in docs.columns])

    keyed = docs.withColumn(key, whole_row_key(docs))
    out = taken(keyed, times)
    left = per_row.where(F.col(over) > 0)
    if left.isEmpty():
        return out
    one = keyed.join(left.select(mix_key), F.col(key) == F.col(mix_key), "left_semi").dropDuplicates([key])
    return out.unionByName(taken(one, over))
