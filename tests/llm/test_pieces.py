"""Encoding against the published library, chunks against whole texts, exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from airlattice.llm import pieces as P
from airlattice.llm.queries import PIECES

TEXTS = ["Hello world.", "  two  blanks and more   ", "naïve café, 日本語 テキスト!", "tab\tand\nnew line\n\n", "emoji 😀 and ▁ sign",
         "a" * 300, "x" + " " * 40 + "y", "0123456789" * 30, "thetheandofthe" * 20, " ", "▁▁"]


@pytest.fixture(scope="module")
def uniform(tmp_path_factory):
    """The vocabulary as a unigram model, with the scores of unused pieces moved near the others: single
    precision, which the library sums in, then holds every sum exactly."""
    m = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.score < -1e6:
            p.score = -40000
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


def ids(p, text):
    return np.frombuffer(p.encode(text), np.int32).tolist()


def test_equals_the_library(uniform):
    library, p = sentencepiece.SentencePieceProcessor(model_file=uniform), P.vocabulary(uniform)
    rng = random.Random(1)
    texts = [t for t in TEXTS if "▁" not in t and len(t) < 400]
    texts += [" ".join("".join(rng.choice("theandofing,.X") for _ in range(rng.randint(1, 9))) for _ in range(20)) for _ in range(200)]
    for t in texts:
        assert ids(p, t) == library.encode(t), t
        assert library.decode(ids(p, t)) == t == p.decode(np.array(ids(p, t)))


@pytest.mark.parametrize("size", [16, 17, 23, 64, 301])
def test_chunks_equal_the_whole(size):
    p = P.vocabulary(PIECES)
    for text in [t * 3 for t in TEXTS]:
        whole = " " + text
        cut = [(whole[k:k + size], whole[k + size:k + size + p.longest]) for k in range(0, len(whole), size)]
        matrices = [P.chunk_matrix(p, *c) for c in cut]
        ahead = P.forward(matrices)
        leave = P.exits([P.choices(p, *c, v) for c, v in zip(cut, ahead)])
        got = np.concatenate([P.backtrace(p, *c, v, x) for c, v, x in zip(cut, ahead, leave)]).tolist()
        assert got == ids(p, text), text


def test_combination_is_associative():
    p = P.vocabulary(PIECES)
    text = "thetheandofthe" * 20
    cut = [(text[k:k + 40], text[k + 40:k + 40 + p.longest]) for k in range(0, 120, 40)]
    a, b, c = (P.transfer(p, *x) for x in cut)
    left, right = P.combine(P.combine(a, b), c), P.combine(a, P.combine(b, c))
    assert np.array_equal(left[left > P.NEVER / 2], right[right > P.NEVER / 2])
    whole = P.transfer(p, text[:120], text[120:120 + p.longest])
    real = whole > P.NEVER / 2
    assert np.array_equal(whole[real], left[real])


def test_frame(frame):
    pairs = [*enumerate(TEXTS), (100, None), (101, ""), (102, "long text " * 900), (3, TEXTS[3])]
    docs = frame(pairs, extra=["ids", "giant_row"])
    whole = P.encode_pieces(docs, PIECES)
    assert whole.columns[-2:] == ["ids_1", "same"]
    want = sorted((r.doc_id, list(r.ids_1)) for r in whole.collect() if r.ids_1 is not None)
    cut = P.decode_pieces(P.encode_pieces(docs, PIECES, chunk=200), PIECES, ids="ids_1").collect()
    assert sorted((r.doc_id, list(r.ids_1)) for r in cut if r.ids_1 is not None) == want
    assert len(cut) == len(pairs) and all(r.decoded == r.text and r.same for r in cut)
    assert P.encode_pieces(frame([]), PIECES).count() == 0
