"""The trie against a plain one built of tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

from airlattice.llm import prefixtrie as P
from airlattice.llm import queries

ROWS = "conv_id LONG, turn LONG, role STRING, text STRING"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{role}\n{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        value = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += value
            leaves[k[:d]] += not children.get(k)
    return sorted((min(m), len(k), -1 if not k else min(members[k[:-1]]), len(m), len(children.get(k, ())), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, ends.get(k, []))).encode()).hexdigest()) for k, m in members.items())


def found(spark, rows, schema=ROWS, **kw):
    got = P.prefix_trie(spark.createDataFrame(rows, schema).repartition(3), **kw).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *tuple(r)[3:]) for r in got)


def test_random_tries(shipped):
    """Few different turns, so chains branch at every depth, end at branches and repeat each other."""
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["u", "a"]), rng.choice(["x", "é", ""])) for c in rng.sample(range(400), 90) for t in range(rng.randrange(1, 7))]
    assert found(shipped, rows) == brute(rows)


def test_nulls_ties_and_repeats(shipped):
    rows = [(5, None, "u", "b"), (5, 1, None, None), (5, 1, "u", "tie"), (5, 1, "u", "tie"), (5, 1, "a", "other"), (6, 3, "u", None),
            (7, None, None, "only"), (None, 0, "u", "no conversation"), (10, 0, "u", "x" * 200_000), (11, 0, "u", "x" * 200_000),
            (10, 0, "u", "x" * 200_000), (4, 2, "a", "late"), (4, 1, "u", "early"), (36, 0, "u", "b")]
    assert found(shipped, rows) == brute(rows)


def test_one_long_conversation_and_many_copies(shipped, monkeypatch):
    """A path far deeper than a block, and more equal conversations than a digest block holds."""
    monkeypatch.setattr(P, "BLOCK", 64)
    monkeypatch.setattr(P.running, "__defaults__", (64, False))
    rows = [(1, t, "u", str(t % 7)) for t in range(900)] + [(1000 + 5 * k, 0, "u", "copy") for k in range(300)]
    rows += [(c, t, "u", str(t % 7)) for c in (2, 3) for t in range(450 + c)]
    # Sums over all prefixes of 900 turns: compare against the brute force, which holds them all.
    assert found(shipped, rows) == brute(rows)


def test_empty_and_clashing_columns(shipped):
    assert found(shipped, []) == []
    rows = [(1, 0, "u", "x"), (2, 0, "u", "x")]
    extra = shipped.createDataFrame([(*r, 9, 9) for r in rows], ROWS + ", conv INT, part INT")
    got = sorted(tuple(r)[:2] for r in P.prefix_trie(extra).collect())
    assert got == [r[:2] for r in brute(rows)]


def test_query_contract(shipped):
    got = queries.QUERIES["op13_prefix_tour"](shipped, "/root/testdata/sf0.001")
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in shipped.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    assert sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *tuple(r)[3:]) for r in got.collect()) == brute(rows)
