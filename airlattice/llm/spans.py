"""Substring duplicates by sliding sentence spans.

Every run of several consecutive sentences is hashed and joined globally. The first holder of a run keeps it;
in every other document, and later in the same document, the sentences that the run covers are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice.llm.common import col, fresh, row_type, stored, words

#: A run has at least so many sentences and words.
SENTENCES, WORDS = 2, 20
#: A sentence ends with a line, or with closing punctuation before a blank.
SENTENCE = re.compile(r"[^\n]*?(?:[.!?…]+[\"'”»)]*(?=[ \t])|(?=\n)|\Z)[ \t]*\n*", re.S)


def sentences(text: str | None) -> list[str]:
    """Sentences with the blanks behind them: joined, they are the text."""
    out, lead = [], ""
    for m in SENTENCE.finditer(text or ""):
        part = m[0]
        if not part:
            continue
        if words(part):
            out.append(lead + part)
            lead = ""
        elif out:
            out[-1] += part
        else:
            lead += part
    if lead:
        out.append(lead)
    return out


def runs(parts: list[str], least: int = SENTENCES, least_words: int = WORDS) -> list[tuple[int, int]]:
    """(first, last) of the shortest runs with enough sentences and words from every start, and up to every end.

    Both kinds together cover every sentence of a repeated passage that is at least one run long.
    """
    n = len(parts)
    total = [0]
    for x in parts:
        total.append(total[-1] + len(words(x)))
    out, end = set(), 0
    for start in range(n):
        end = max(end, start + least)
        while end <= n and total[end] - total[start] < least_words:
            end += 1
        if end > n:
            break
        out.add((start, end - 1))
    start = n
    for end in range(n, 0, -1):
        start = min(start, end - least)
        while start >= 0 and total[end] - total[start] < least_words:
            start -= 1
        if start < 0:
            break
        out.add((start, end - 1))
    return sorted(out)


def run_rows(text: str | None, least: int, least_words: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """(first hash, second hash, first, last, again): ``again`` where the text held the run before."""
    parts = sentences(text)
    keys, seen = [b" ".join(words(x)) for x in parts], set()
    for start, end in runs(parts, least, least_words):
        h = xxhash.xxh3_128_intdigest(b"\n".join(keys[start:end + 1]))
        a, b = (h >> 64) - (1 << 63), (h & 0xFFFFFFFF) - (1 << 31)
        yield a, b, start, end, (a, b) in seen
        seen.add((a, b))


def _find_runs(least: int, least_words: int):
    schema = pa.schema([("doc", pa.int64()), ("body", pa.int64()), ("a", pa.int64()), ("b", pa.int32()),
                        ("start", pa.int32()), ("end", pa.int32()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, body, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                rows += [(doc, body, *r) for r in run_rows(text, least, least_words)]
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


@F.pandas_udf(row_type("n_sentences int, n_removed int, text string"))
def _without(texts: pd.Series, covered: pd.Series) -> pd.DataFrame:
    rows = []
    for text, spans in zip(texts, covered):
        parts, gone = sentences(text), set()
        for span in spans if spans is not None else ():
            gone.update(range(span["start"], span["end"] + 1))
        rows.append((len(parts), len(gone), text if not gone else "".join(x for k, x in enumerate(parts) if k not in gone)))
    return pd.DataFrame(rows, columns=["n_sentences", "n_removed", "text"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = SENTENCES,
                   least_words: int = WORDS, out: str = "deduplicated") -> DataFrame:
    """The frame with one more column, a struct: n_sentences, n_removed and the text that remains.

    The first holder of a run is the document with the smallest doc_id (null first), of several texts with that
    doc_id, or without any, the one with the smallest hash, and in it the first place. Rows equal in doc_id and text are
    one document: they keep and lose the same sentences. Null text stays null, with no sentences; texts
    shorter than a run stay whole. ``out`` gets a number where the frame has such a column.
    """
    name, doc, body, covered = fresh(docs, out, "doc_key", "body_key", "covered_spans")
    lowest = F.lit(-(2**63)).cast("long")
    keyed = docs.withColumn(doc, F.coalesce(col(doc_id).cast("long"), lowest)).withColumn(body, F.xxhash64(col(text)))
    found = keyed.select(doc, body, col(text)).mapInArrow(
        _find_runs(least, least_words), row_type("doc long, body long, a long, b int, start int, end int, again boolean"))
    found = stored(found, "runs")
    # One row per document and run; what a document repeats itself needs no partner.
    firsts = found.where("NOT again").groupBy("a", "b").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.min("body").alias("low_body"), F.max("body").alias("high_body"))
    firsts = firsts.where("high > low OR high_body > low_body").select("a", "b", "low")
    shared = stored(found.where("NOT again").join(firsts, ["a", "b"]).select("a", "b", "doc", "body", "start", "end", "low"), "shared")
    # Several texts with the lowest doc_id: only then their hashes decide.
    heads = shared.where("doc = low").groupBy("a", "b").agg(F.min("body").alias("first_body"), F.max("body").alias("last_body")) \
        .where("last_body > first_body").select("a", "b", "first_body")
    shared = shared.join(heads, ["a", "b"], "left").where("doc > low OR body > first_body")
    spans = shared.select("doc", "body", "start", "end").unionByName(found.where("again").select("doc", "body", "start", "end"))
    spans = spans.groupBy("doc", "body").agg(F.collect_set(F.struct("start", "end")).alias(covered)) \
        .withColumnRenamed("doc", f"{doc}_r").withColumnRenamed("body", f"{body}_r")
    joined = keyed.join(spans, (F.col(doc) == F.col(f"{doc}_r")) & (F.col(body) == F.col(f"{body}_r")), "left")
    made = joined.withColumn(name, _without(col(text), F.col(covered)))
    return made.select(*[col(c) for c in docs.columns], F.col(name))
