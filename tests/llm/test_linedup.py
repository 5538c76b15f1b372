"""Line dedup against a plain loop over documents in order."""

import hashlib
import random
from collections import Counter

import pytest
import xxhash

from airlattice.llm import linedup as L
from airlattice.llm import queries
from tests.llm.conftest import DOCS

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, least=10):
    """(id, n_lines, n_dropped, text) of each row, in any order."""
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(k := key_of(line)) >= least:
                holders.setdefault(k, []).append((i, t or ""))
    first = {}
    for k, held in holders.items():
        ids = [i for i, _ in held if i is not None]
        first[k] = min(ids) if ids else min((text_hash(t) for _, t in held))
    out = []
    for i, t in rows:
        lines, keep = (t or "").split("\n"), []
        for line in lines:
            k = key_of(line)
            has_id = k in first and any(j is not None for j, _ in holders[k])
            gone = k in first and (i > first[k] if i is not None else has_id or text_hash(t or "") > first[k])
            if not gone:
                keep.append(line)
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return Counter(out)


def text_hash(text):
    """Spark's xxhash64 of (1, true, null, text), signed."""
    seed = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    seed = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed)
    h = xxhash.xxh64_intdigest(text.encode(), seed)
    return h - (1 << 64) if h >> 63 else h


def found(df, **kw):
    return Counter((r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_dropped, r.line_dedup.text) for r in L.dedup_lines(df, **kw).collect())


LINES = ["a line that many hold", "  A Line That Many HOLD\t", "short", "", "   ", "Ünïcode LINE of some length", "ünïcode line of some length",
         "Ünïcode line of SOME length\r", "another line, number 1", "another line, number 2", "tenletters", "nineletts"]


@pytest.mark.parametrize("batches,fanout", [(1, 3), (4, 3), (7, 2)])
def test_random_documents(frame, batches, fanout):
    rng = random.Random(batches)
    rows = [(k, "\n".join(rng.choice(LINES + [f"own line of document {k}"]) for _ in range(rng.randrange(9)))) for k in range(120)]
    rng.shuffle(rows)
    assert found(frame(rows), batches=batches, fanout=fanout) == brute(rows)


def test_null_empty_repeated_and_tied(frame):
    shared = "a line that is shared"
    rows = [(None, shared), (None, shared), (None, f"{shared}\nmore"), (3, shared), (3, f"x\n{shared}"), (3, shared), (9, None), (9, ""),
            (None, None), (12, "\n"), (12, f"{shared}\n{shared}"), (None, "only without ids"), (None, "only without ids\nand more of it")]
    assert found(frame(rows)) == brute(rows)


def test_clashing_columns_and_types(frame):
    df = frame([(1, "the same long line"), (2, "the same long line\nrest")], extra=("ra", "gone", "line_dedup", "batch", "a", "pos", "line"))
    got = L.dedup_lines(df)
    assert got.columns == [*df.columns, "line_dedup_1"]
    assert {(r.doc_id, r.gone, r.line_dedup_1.text) for r in got.collect()} == {(1, 1, "the same long line"), (2, 1, "rest")}


def test_empty_table(shipped):
    assert L.dedup_lines(shipped.createDataFrame([], DOCS)).count() == 0


def test_long_text_is_linear(frame):
    text = "\n".join(f"line number {k % 50_000} of the text" for k in range(200_000))
    rows = [(1, "\n".join(f"line number {k} of the text" for k in range(0, 50_000, 2))), (2, text), (3, "x" * 1_000_000 + "\n" + "y" * 20)]
    assert found(frame(rows)) == brute(rows)


def test_runs_are_levelled(frame):
    """Runs hold every key once, whatever the compaction, and only new keys are added."""
    runs, seen = L.LineRuns(frame([]).sparkSession, fanout=2), []
    for k in range(5):
        lines = L.hashed_lines(frame([(k, f"line of batch {k} alone\nline of every batch")]))
        seen.append(runs.add(lines).count())
        runs.compact()
    assert seen == [0, 1, 1, 1, 1]
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sum(runs.spark.table(r.name).count() for r in runs.runs()) == 6
    runs.close()


def test_query_contract(shipped):
    got = queries.QUERIES["op11_line_runs"](shipped, "/root/testdata/sf0.001")
    assert got.dtypes == [("doc_id", "bigint"), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")]
    docs = [(r.doc_id, r.text) for r in shipped.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs).elements())
    assert Counter(tuple(r) for r in got.collect()) == want
