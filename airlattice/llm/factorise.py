"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document with features x is w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j. The pair term
is computed in linear time as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, for each factor.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlattice.llm.common import col, fresh, row_type, words

FACTORS = 8
WORD_SLOTS = 1 << 15
STATISTICS = 14
BINS = 12
SLOTS = WORD_SLOTS + STATISTICS * BINS
FOLDS = 5
THRESHOLD = 0.3
SYMBOLS = b"#*$%&|<>"


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray


def statistics(text: str, w: list[bytes], tally: Counter, n_chars: int | None) -> list[float]:
    """Structure statistics and metadata, each scaled to 0..1."""
    n, size = len(w), len(text)
    lines = [x for x in text.split("\n") if x]
    pairs = len(set(zip(w, w[1:]))) / (n - 1) if n > 1 else 1.0
    known = size if n_chars is None else n_chars
    per_word = lambda x: x / n if n else 0.0
    return [
        min(1.0, np.log1p(n) / 12), min(1.0, np.log1p(len(lines)) / 8), min(1.0, size / n / 16) if n else 0.0,
        len(tally) / n if n else 1.0, pairs, len(set(lines)) / len(lines) if lines else 1.0,
        per_word(sum(map(bytes.isupper, w))), per_word(sum(map(bytes.istitle, w))), per_word(sum(map(bytes.isdigit, w))),
        min(1.0, per_word(sum(map(text.encode("utf-8", "surrogatepass").count, (SYMBOLS[k:k + 1] for k in range(len(SYMBOLS))))))),
        min(1.0, per_word(text.count("!"))), min(1.0, per_word(sum(map(text.count, ".?,")))),
        max(tally.values()) / n if n else 0.0, min(1.0, np.log1p(max(0, known)) / 14),
    ]


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: hashed words by damped count, of unit length, and one unit feature per statistic's bin."""
    text = text or ""
    w = words(text)
    tally = Counter(w)
    slots = np.fromiter((crc32(x) % WORD_SLOTS for x in tally), np.int64, len(tally))
    values = np.log1p(np.fromiter(tally.values(), np.float64, len(tally)))
    if len(values):
        values /= np.sqrt((values**2).sum())
    stats = np.minimum((np.array(statistics(text, w, tally, n_chars)) * BINS).astype(np.int64), BINS - 1)
    own = WORD_SLOTS + np.arange(STATISTICS) * BINS + stats
    return np.concatenate([slots, own]), np.concatenate([values, np.full(STATISTICS, STATISTICS**-0.5)])


def raw_scores(m: Machine, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Scores of many documents laid end to end; every one has features, so no segment is empty."""
    vx = m.v[slots] * values[:, None]
    whole = np.add.reduceat(vx, starts, axis=0)
    squares = np.add.reduceat(vx**2, starts, axis=0)
    return m.w0 + np.add.reduceat(m.w[slots] * values, starts) + 0.5 * (whole**2 - squares).sum(1)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.1, decay: float = 1e-5,
        batch: int = 64, seed: int = 42) -> Machine:
    """Logistic loss, adaptive gradient per weight. Without rows every document scores a half."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SLOTS), rng.normal(0, 0.02, (SLOTS, FACTORS)))
    if not rows:
        m.v[:] = 0
        return m
    share = min(max(np.mean([y for _, _, y in rows]), 1e-3), 1 - 1e-3)
    m.w0 = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_0 = np.full(SLOTS, 1e-6), np.full((SLOTS, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = [rows[k] for k in order[at:at + batch]]
            sizes = np.array([len(s) for s, _, _ in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            slots, values = np.concatenate([s for s, _, _ in part]), np.concatenate([x for _, x, _ in part])
            y = np.array([y for _, _, y in part], float)
            err = (1 / (1 + np.exp(-np.clip(raw_scores(m, slots, values, starts), -30, 30))) - y) / len(part)
            each = np.repeat(err, sizes)
            vx = m.v[slots] * values[:, None]
            whole = np.repeat(np.add.reduceat(vx, starts, axis=0), sizes, axis=0)
            grad_v = each[:, None] * values[:, None] * (whole - vx)
            used, where = np.unique(slots, return_inverse=True)
            gw = np.bincount(where, each * values, len(used)) + decay * m.w[used]
            gv = np.stack([np.bincount(where, grad_v[:, f], len(used)) for f in range(FACTORS)], 1) + decay * m.v[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            m.w[used] -= rate * gw / np.sqrt(seen_w[used])
            m.v[used] -= rate * gv / np.sqrt(seen_v[used])
            seen_0 += err.sum() ** 2
            m.w0 -= rate * err.sum() / np.sqrt(seen_0)
    return m


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


@F.pandas_udf(row_type("slots binary, vals binary"))
def _featurise(texts: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
    made = [features(t, None if pd.isna(n) else int(n)) for t, n in zip(texts, n_chars)]
    return pd.DataFrame({"slots": [s.astype(np.int32).tobytes() for s, _ in made],
                         "vals": [x.astype(np.float32).tobytes() for _, x in made]})


def _length(docs: DataFrame, n_chars: str | None) -> Column:
    return (col(n_chars) if n_chars in docs.columns else F.lit(None)).cast("long")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
          label: str = "quality", sample_rows: int = 6000) -> Machine:
    """Fit on at most ``sample_rows`` labelled documents outside fold 0, those with the smallest hashed ids.

    That bound holds for the broadcast ids and for what reaches the driver. Labels other than 0 and 1, and
    rows without id, are left out; of several rows with one id the largest text counts.
    """
    ids = labels.select(col(doc_id).alias("i"), col(label).cast("int").alias("y")).where("i IS NOT NULL AND y IN (0, 1)") \
        .where(fold(F.col("i")) != 0).groupBy("i").agg(F.max("y").alias("y")).orderBy(F.xxhash64("i"), "i").limit(sample_rows)
    made = docs.select(col(doc_id).alias("i"), col(text).alias("t"), _length(docs, n_chars).alias("n")) \
        .join(F.broadcast(ids), "i").select("i", "y", _featurise("t", "n").alias("f")) \
        .select("i", "y", "f.slots", "f.vals").groupBy("i", "y").agg(F.max("slots").alias("slots"), F.max_by("vals", "slots").alias("vals"))
    return fit([(np.frombuffer(r.slots, np.int32).astype(np.int64), np.frombuffer(r.vals, np.float32).astype(float), r.y)
                for r in made.orderBy("i").collect()])


def score_quality(docs: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text",
                  n_chars: str | None = "n_chars", threshold: float = THRESHOLD, out: str = "quality_score") -> DataFrame:
    """The frame with one more column, a struct: held_out, score (0 to 1), predicted (1 from the threshold on).

    Whole texts are read; null counts as empty and is scored by structure alone, as is an empty text. A null id
    is not held out. ``out`` gets a number where the frame has such a column; equal rows score equally.
    """
    w0, w, v = machine.w0, machine.w.astype(np.float32), machine.v.astype(np.float32)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = Machine(w0, w.astype(float), v.astype(float))
        for texts, lengths in batches:
            out_scores = []
            for t, n in zip(texts, lengths):
                slots, values = features(t, None if pd.isna(n) else int(n))
                out_scores.append(raw_scores(m, slots, values, np.array([0]))[0])
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out_scores, float), -30, 30))))

    name, tmp = fresh(docs, out, "raw_score")
    scored = docs.withColumn(tmp, score(col(text), _length(docs, n_chars)))
    return scored.withColumn(name, F.struct(
        F.coalesce(fold(col(doc_id)) == 0, F.lit(False)).alias("held_out"), F.col(tmp).alias("score"),
        (F.col(tmp) >= threshold).cast("int").alias("predicted"))).drop(tmp)
