"""The registered queries as they are registered: columns, types and what can be recounted from the tables."""

import re
import zlib
from collections import defaultdict

import pytest

from airlattice.llm import budget, queries
from tests.llm.test_private import plain_spans

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


def run(shipped, name, types):
    got = queries.QUERIES[name](shipped, FOLDER)
    assert got.dtypes[:len(types)] == list(types.items())
    return got.collect()


def test_op1(shipped):
    rows = run(shipped, "op1_main_text", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"})
    pages = shipped.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert sorted((r.page_id, r.url) for r in rows) == sorted((p.page_id, p.url) for p in pages)
    for r in rows:
        assert r.n_chars == len(r.text)
        assert all(b == " ".join(b.split()) and b for b in r.text.split("\n\n")) or r.text == ""


def test_op2(shipped, docs):
    rows = run(shipped, "op2_jaccard_join", {"doc_id": "bigint", "class_id": "bigint", "n_links": "bigint"})
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    assert all(r.class_id <= r.doc_id for r in rows)
    groups = defaultdict(list)
    for r in rows:
        groups[r.class_id].append(r)
    assert all(min(r.doc_id for r in g) == c and all((r.n_links > 0) == (len(g) > 1) and r.n_links < len(g) for r in g) for c, g in groups.items())


def test_op3(shipped):
    rows = run(shipped, "op3_token_shards", {"slot": "bigint", "shard": "int", "byte_offset": "bigint", "n_tokens": "int"})
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.byte_offset == (r.slot % 8192) * 2048 and r.shard == r.slot // 8192 and 0 < r.n_tokens <= 1024 for r in rows)


def test_op4(shipped, docs):
    rows = run(shipped, "op4_sentence_spans", {"doc_id": "bigint", "n_sentences": "int", "n_removed": "int", "text": "string"})
    texts = {d.doc_id: d.text for d in docs}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all((r.text == texts[r.doc_id]) == (r.n_removed == 0) and r.n_removed <= r.n_sentences for r in rows)


def test_op5(shipped, docs):
    rows = run(shipped, "op5_quality_machine", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"})
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op6(shipped, docs):
    rows = run(shipped, "op6_budget_mix", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"})
    sizes, source_of, total, taken, longest = {}, {}, defaultdict(int), defaultdict(int), defaultdict(int)
    for d in docs:
        sizes[d.doc_id], source_of[d.doc_id] = len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")), d.source
        total[d.source] += sizes[d.doc_id]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, budget.targets([total[s] for s in order], [(5.0, 2.0, 1.0)[k % 3] for k in range(len(order))])))
    assert sorted(sizes) == sorted(r.doc_id for r in rows)
    for r in rows:
        source = source_of[r.doc_id]
        assert (r.size, r.source_size) == (sizes[r.doc_id], total[source]) and r.target == pytest.approx(targets[source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source] += r.taken
        longest[source] = max(longest[source], r.size)
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in order)


def test_op8(shipped, docs):
    rows = run(shipped, "op8_sentence_pieces", {"doc_id": "bigint", "n_pieces": "bigint"})
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    assert all(r.same and r.n_pieces == len(r.ids) for r in rows)


def test_op9(shipped, docs):
    rows = {r.doc_id: r for r in run(shipped, "op9_personal_data", {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"})}
    assert sorted(rows) == sorted(d.doc_id for d in docs)
    for d in docs:
        base, r = plain_spans(d.text or ""), rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(filter(None, r.spans.split(",")))
