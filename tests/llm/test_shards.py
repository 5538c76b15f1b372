"""Permutation, shards and an exact round trip of the tokens."""

import random
import sys

import numpy as np
import pytest
import tiktoken

from airlattice.llm import shards as S
from airlattice.llm.common import stored
from airlattice.llm.queries import BYTE_PAIRS


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation(n):
    x = np.arange(n)
    y = S.feistel(x, n, key=5)
    assert sorted(y) == list(x)
    assert n < 100 or (y != S.feistel(x, n, key=6)).any() and (y != x).mean() > 0.9


def test_tokens_equal_the_library():
    t = S.tokens_of(BYTE_PAIRS)
    for text in ["a b  c", " lead", "trail ", "two\n\nlines  of\ttext", "It's 100% \n x", "日本 語 ü", "a \nb", " x   y"]:
        want = t.encoding.encode_ordinary(text) + [t.end]
        assert np.frombuffer(t.encode(text), t.kind).tolist() == want and t.count(text) == len(want)
    assert t.encode(None) == t.encode("") == b"" and t.count(None) == t.count("") == 0


def test_round_trip(frame, tmp_path):
    pairs = [(k, " ".join(f"word{k} {j}" for j in range(1 + k * 7 % 90))) for k in range(60)]
    pairs += [(100, None), (101, ""), (None, "no id here"), (5, pairs[5][1])]
    docs = stored(frame(pairs, extra=["part", "slot"]))
    folder = f"file://{tmp_path}/shards"
    index = S.write_shards(docs, BYTE_PAIRS, folder=folder, length=32, shard_slots=16)
    rows = sorted(index.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.byte_offset == (r.slot % 16) * 64 and r.shard == r.slot // 16 for r in rows)
    sequences = list(S.read_slots(folder, 0, len(rows) + 5, 32, 16))
    assert len(sequences) == len(rows)
    assert [s.tolist() for s in S.read_slots(folder, 19, 23, 32, 16)] == [s.tolist() for s in sequences[19:23]]
    order = S.feistel(np.arange(len(rows)), len(rows), 20240501)
    t = S.tokens_of(BYTE_PAIRS)
    stream = np.concatenate([sequences[s][:rows[s].n_tokens] for s in order]).tolist()
    want = [[*t.encoding.encode_ordinary(x), t.end] for _, x in pairs if x]
    got, now = [], []
    for x in stream:
        now.append(x)
        if x == t.end:
            got.append(now)
            now = []
    assert not now and sorted(got) == sorted(want)
    assert sum(r.n_tokens for r in rows) == sum(map(len, want))
    again = S.write_shards(docs, BYTE_PAIRS, folder=f"file://{tmp_path}/again", length=32, shard_slots=16)
    assert sorted((r.slot, r.sha256) for r in again.collect()) == [(r.slot, r.sha256) for r in rows]


def test_empty(frame):
    assert S.write_shards(stored(frame([])), BYTE_PAIRS).count() == 0
    assert S.write_shards(stored(frame([(1, None), (2, "")])), BYTE_PAIRS).count() == 0


def test_a_single_blank(frame):
    t = S.Tokens(BYTE_PAIRS)
    for text in [" ", "  ", "\t", ".", " ."]:
        want = t.encoding.encode_ordinary(text) + [t.end]
        assert np.frombuffer(t.encode(text), t.kind).tolist() == want and t.count(text) == len(want)
    assert [r.n_tokens for r in S.write_shards(stored(frame([(1, " "), (2, ""), (3, None)])), BYTE_PAIRS).collect()] == [2]


def test_the_library_takes_whole_texts():
    t = S.Tokens(BYTE_PAIRS)
    text, calls = " ".join(f"w{chr(97 + k % 26)}{k * k:x}" for k in range(5000)), 0

    def called(frame, event, what):
        nonlocal calls
        calls += event in ("call", "c_call")

    before = sys.getprofile()
    sys.setprofile(called)
    try:
        ids, n = t.encode(text), t.count(text)
    finally:
        sys.setprofile(before)
    assert np.frombuffer(ids, t.kind).tolist() == t.encoding.encode_ordinary(text) + [t.end] and n == len(ids) // 2
    assert calls < 200  # none for each of the 5,000 words


def test_the_end_token_is_never_read_from_a_text():
    t = S.Tokens(BYTE_PAIRS)
    for text in ["<|endoftext|>", "a<|endoftext|>b", "é <|endoftext|><|endoftext|>"]:
        got = np.frombuffer(t.encode(text), t.kind).tolist()
        assert got.count(t.end) == 1 and got[-1] == t.end and t.count(text) == len(got)
        assert t.encoding.decode(got[:-1]) == text


def test_the_grouped_pattern_equals_the_published_one():
    t = S.Tokens(BYTE_PAIRS)
    published = tiktoken.Encoding("published", pat_str=S.PATTERN, mergeable_ranks=t.encoding._mergeable_ranks, special_tokens={})
    parts = ["a", "É", "word", "日", "'s", "'", "'ll", "1", "½", ".", "!?", "_", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\0",
             "\xa0", "\u2003", "\u3000", "\u0301", "\u200d", "😀", "<|endoftext|>"]
    dice = random.Random(3)
    for _ in range(3000):
        text = "".join(dice.choices(parts, k=dice.randint(1, 12)))
        want = published.encode_ordinary(text) + [t.end]
        assert np.frombuffer(t.encode(text), t.kind).tolist() == want and t.count(text) == len(want)
