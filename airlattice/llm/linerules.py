"""Quality rules by labelling lines: a linear-chain conditional random field marks content and boilerplate.

The field is trained here on a bounded sample of documents whose evident lines carry weak labels; the
other lines stay open, so training maximises the likelihood of the evident ones only. Viterbi decoding
labels every line of every document, and the words in content lines decide whether it is kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice.llm.common import col, fresh, row_type, words

SYMBOLS = "#*$%&|<>"
ENDS = (".", "!", "?", "…", ":", ";", '"', "”", "»", ")")
#: Lines of a training sequence; longer documents give several sequences. Decoding has no such bound.
CHAIN = 32
N_FEATURES = 12
CONTENT, BOILERPLATE = 0, 1


def repeated_words(text: str | None) -> tuple[int, int]:
    """Number of words, and of words that lie in a 3-word window which the text holds twice or more."""
    w = words(text)
    n = len(w)
    if n < 4:
        return n, 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, n)
    if len(ids) < 2**21:
        windows = (a[:-2] * len(ids) + a[1:-1]) * len(ids) + a[2:]
    else:
        pair: dict[tuple[int, int, int], int] = {}
        windows = np.fromiter((pair.setdefault(t, len(pair)) for t in zip(a[:-2].tolist(), a[1:-1].tolist(), a[2:].tolist())), np.int64, n - 2)
    order = np.argsort(windows, kind="stable")
    s = windows[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return n, 0
    hit = np.zeros(n - 2, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return n, int(covered.sum())


def line_table(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Features, word counts and weak labels (-1: open) of the lines with a word, and the number of repeated lines."""
    seen: set[str] = set()
    rows, sizes, marks, n_dup = [], [], [], 0
    for line in (text or "").split("\n"):
        parts = words(line)
        n = len(parts)
        if not n:
            continue
        dup = line in seen
        seen.add(line)
        n_dup += dup
        symbols = sum(map(line.count, SYMBOLS)) / n
        upper = sum(map(bytes.isupper, parts)) / n
        spread = len(set(parts)) / n
        ended = line.rstrip().endswith(ENDS)
        loud = line.count("!") / n
        digits = sum(map(bytes.isdigit, parts)) / n
        rows.append((1.0, dup, symbols > 0.1, symbols > 0.4, upper > 0.3, upper > 0.6, spread < 0.5 and n >= 8,
                     ended, n < 5, n >= 12, loud > 0.2, digits > 0.3))
        if dup or symbols > 0.4 or (upper > 0.6 and n >= 3) or (spread < 0.35 and n >= 8) or loud > 0.4:
            marks.append(BOILERPLATE)
        elif ended and n >= 8 and symbols <= 0.1 and upper <= 0.3 and spread >= 0.5 and loud <= 0.1:
            marks.append(CONTENT)
        else:
            marks.append(-1)
        sizes.append(n)
    return (np.array(rows, np.float64).reshape(-1, N_FEATURES), np.array(sizes, np.int64), np.array(marks, np.int8), n_dup)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def _expected(unary: np.ndarray, trans: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label and transition probabilities by forward and backward passes over all chains at once."""
    n, m, _ = unary.shape
    ahead, back = np.zeros_like(unary), np.zeros_like(unary)
    ahead[:, 0] = unary[:, 0]
    for t in range(1, m):
        step = _logsum(ahead[:, t - 1, :, None] + trans, 1) + unary[:, t]
        ahead[:, t] = np.where(there[:, t, None], step, ahead[:, t - 1])
    for t in range(m - 2, -1, -1):
        step = _logsum(trans + (unary[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(there[:, t + 1, None], step, back[:, t + 1])
    log_z = _logsum(ahead[:, -1], 1)
    label = np.exp(ahead + back - log_z[:, None, None]) * there[:, :, None]
    moves = np.zeros((2, 2))
    for t in range(1, m):
        joint = np.exp(ahead[:, t - 1, :, None] + trans + (unary[:, t] + back[:, t])[:, None, :] - log_z[:, None, None])
        moves += joint[there[:, t]].sum(0)
    return label, moves


def fit_field(chains: list[tuple[np.ndarray, np.ndarray]], steps: int = 60, rate: float = 0.3,
              decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature, label) and transitions (label, label), by gradient ascent with running scale.

    Without any chain, or without evident lines, the weights stay zero and ties decode as content.
    """
    weights, trans = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    cut = [(x[k:k + CHAIN], y[k:k + CHAIN]) for x, y in chains for k in range(0, len(x), CHAIN)]
    cut = [(x, y) for x, y in cut if (y >= 0).any()]
    if not cut:
        return weights, trans
    m = max(len(x) for x, _ in cut)
    feats, marks, there = np.zeros((len(cut), m, N_FEATURES)), np.full((len(cut), m), -1), np.zeros((len(cut), m), bool)
    for k, (x, y) in enumerate(cut):
        feats[k, :len(x)], marks[k, :len(x)], there[k, :len(x)] = x, y, True
    barred = np.zeros((len(cut), m, 2))
    for label in (0, 1):
        barred[..., label][(marks >= 0) & (marks != label)] = -1e4
    scale_w, scale_t, total = np.full_like(weights, 1e-8), np.full_like(trans, 1e-8), there.sum()
    for _ in range(steps):
        unary = feats @ weights
        free, free_moves = _expected(unary, trans, there)
        held, held_moves = _expected(unary + barred, trans, there)
        grad_w = np.einsum("nmf,nml->fl", feats, held - free) / total - decay * weights
        grad_t = (held_moves - free_moves) / total - decay * trans
        scale_w, scale_t = scale_w + grad_w**2, scale_t + grad_t**2
        weights, trans = weights + rate * grad_w / np.sqrt(scale_w), trans + rate * grad_t / np.sqrt(scale_t)
    return weights, trans


def viterbi(feats: np.ndarray, weights: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best labels of one document's lines; ties go to content."""
    n = len(feats)
    if not n:
        return np.zeros(0, np.int8)
    scores = (feats @ weights).tolist()
    (cc, cb), (bc, bb) = trans.tolist()
    c, b = scores[0]
    came = []
    for sc, sb in scores[1:]:
        from_c, from_b = b + bc > c + cc, b + bb > c + cb
        came.append((from_c, from_b))
        c, b = (b + bc if from_c else c + cc) + sc, (b + bb if from_b else c + cb) + sb
    out = np.zeros(n, np.int8)
    now = b > c
    for t in range(n - 1, -1, -1):
        out[t] = now
        if t:
            now = came[t - 1][1 if now else 0]
    return out


RULES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
         "kept boolean, content_words long, n_lines long")


def rule_udf(weights: np.ndarray, trans: np.ndarray, min_share: float):
    names = [field.split()[0] for field in RULES.split(", ")]

    def judge(text: str | None) -> tuple:
        text = text or ""
        n, repeated = repeated_words(text)
        feats, sizes, _, n_dup = line_table(text)
        content = int(sizes[viterbi(feats, weights, trans) == CONTENT].sum())
        failed = n < 50 or 100 * repeated > 50 * n
        chars = len(text) - sum(map(text.count, "\x20\x09\x0a\x0b\x0c\x0d"))
        return (n, chars, sum(map(text.count, SYMBOLS)), n_dup, repeated, failed,
                not failed and content >= min_share * n, content, len(sizes))

    @F.pandas_udf(row_type(RULES))
    def judge_all(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([judge(t) for t in texts], columns=names)

    return judge_all


def drawn_lines(key: str, n: int, chains: int) -> np.ndarray:
    """Places of the lines of ``chains`` runs of CHAIN lines, drawn by hash from all runs of a document of ``n`` lines."""
    runs = sorted(range(-(-n // CHAIN)), key=lambda k: (zlib.crc32(f"{key}/{k}".encode()), k))[:chains]
    return np.array([k for run in sorted(runs) for k in range(run * CHAIN, min(n, (run + 1) * CHAIN))], np.int64)


def train_field(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = 1000,
                sample_chains: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Fit on the ``sample_docs`` documents with the smallest hashed ids: the bound of what reaches the driver.

    Of each at most ``sample_chains`` runs of CHAIN lines are used, drawn by hash from the whole text.
    """
    ids = docs.select(col(doc_id).alias("i")).where("i IS NOT NULL").distinct() \
        .orderBy(F.xxhash64("i"), "i").limit(sample_docs)
    picked = docs.select(col(doc_id).alias("i"), col(text).alias("t")).join(F.broadcast(ids), "i") \
        .groupBy("i").agg(F.max("t").alias("t"))

    @F.pandas_udf(row_type("x binary, y binary"))
    def lines(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        made = [line_table(t) for t in texts]
        drawn = [drawn_lines(key, len(x), sample_chains) for key, (x, _, _, _) in zip(keys, made)]
        return pd.DataFrame({"x": [x[at].astype(np.uint8).tobytes() for at, (x, _, _, _) in zip(drawn, made)],
                             "y": [y[at].tobytes() for at, (_, _, y, _) in zip(drawn, made)]})

    rows = picked.select("i", lines(F.col("i").cast("string"), "t").alias("l")).select("i", "l.x", "l.y").orderBy("i").collect()
    return fit_field([(np.frombuffer(r.x, np.uint8).reshape(-1, N_FEATURES).astype(float), np.frombuffer(r.y, np.int8)) for r in rows])


def judge_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_share: float = 0.5,
                sample_docs: int = 1000, out: str = "rules") -> DataFrame:
    """The frame with one more column, a struct of the base counts, ``base_failed``, ``kept`` and the content words.

    Null text counts as empty and fails the base. A document is kept when its base did not fail and content
    lines hold at least ``min_share`` of its words. Repeated rows each get their own, equal, verdict; an empty
    table gives an empty table; ``out`` gets a number where the frame has such a column.
    """
    weights, trans = train_field(docs, doc_id, text, sample_docs)
    return docs.withColumn(fresh(docs, out)[0], rule_udf(weights, trans, min_share)(col(text)))
