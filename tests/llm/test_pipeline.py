"""The pipeline's stages, each on what the one before kept."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from airlattice.llm import jaccard
from airlattice.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no shared tables")


def test_stages_in_order(shipped):
    docs = table(shipped, FOLDER, "documents")
    names, kept = docs.columns, {}
    for name, stage in C.STAGES:
        docs = stored(stage(shipped, docs, FOLDER))
        kept[name] = docs
        if name != "SentencePiece":
            assert docs.columns == names
    labels = table(shipped, FOLDER, "labels")
    clean = labels.where("quality = 1").select("doc_id")
    good = kept["quality classifier"]
    assert good.join(clean, "doc_id", "left_semi").count() >= 0.97 * clean.count()
    one = kept["n-gram Jaccard join"]
    again = jaccard.join_similar(one).where("n_links > 0")
    assert again.count() == 0
    assert kept["personal data"].count() == one.count()
    assert kept["personal data"].where("n_chars <> char_length(text)").count() == 0
    words = F.size(F.split("text", r"\s+"))
    before, after = (kept[k].agg(F.sum(words)).first()[0] for k in ("personal data", "mixing sources"))
    assert 0.98 * before < after < 1.02 * before
    last = kept["SentencePiece"]
    assert last.where("NOT same OR n_pieces <> size(ids)").count() == 0
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in kept["mixing sources"].collect())


def test_odd_documents(shipped):
    rows = [(1, None, "en", None, None, 0), (2, "", "en", "a", 0, 0), (2, "", "en", "a", 0, 0), (None, "some words", None, "b", 10, 0)]
    docs = shipped.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, copy INT")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in C.STAGES:
            now = stored(stage(shipped, now, FOLDER))
        assert not empty or now.count() == 0
