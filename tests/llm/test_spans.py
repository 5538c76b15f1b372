"""Repeated sentence spans against a sequential version."""

import random

from airlattice.llm import spans as S


def sequential(pairs):
    """Documents by id; a run that an earlier place holds covers its sentences."""
    seen, out = {}, {}
    for i, text in sorted(pairs, key=lambda p: p[0]):
        parts = S.sentences(text)
        keys, gone = [b" ".join(S.words(p)) for p in parts], set()
        for a, b in S.runs(parts):
            key = tuple(keys[a:b + 1])
            if seen.setdefault(key, (i, a)) != (i, a):
                gone.update(range(a, b + 1))
        out[i] = (len(parts), len(gone), None if text is None else "".join(p for k, p in enumerate(parts) if k not in gone))
    return out


def prose(rng, n):
    return " ".join(" ".join(f"w{rng.randint(0, 99999)}" for _ in range(rng.randint(1, 25))) + rng.choice(".!?") for _ in range(n))


def test_equals_sequential(frame):
    rng = random.Random(9)
    shared = [prose(rng, 8) for _ in range(4)]
    pairs = []
    for k in range(80):
        parts = [prose(rng, rng.randint(1, 9)) for _ in range(3)]
        if k % 2:
            parts.insert(1, shared[k % 4])
        if k % 7 == 0:
            parts.append(parts[0])
        pairs.append((k, rng.choice(["\n", " "]).join(parts)))
    pairs += [(200, None), (201, ""), (202, "\n \n"), (203, pairs[1][1]), (204, "No end")]
    got = S.remove_repeats(frame(pairs, extra=["deduplicated", "doc_key"]))
    assert got.columns[-1] == "deduplicated_1"
    rows = {r.doc_id: tuple(r.deduplicated_1) for r in got.collect()}
    assert rows == sequential(pairs)
    assert rows[203][2] == ""


def test_a_long_passage_is_covered_wholly():
    rng = random.Random(2)
    for _ in range(300):
        passage = prose(rng, rng.randint(2, 7))
        if len(passage.split()) < 50:
            continue
        a, b = [S.sentences(f"{prose(rng, 4)} {passage} {prose(rng, 4)}") for _ in range(2)]
        keys = [[tuple(S.words("".join(x[i:j + 1]))) for i, j in S.runs(x)] for x in (a, b)]
        covered = set()
        for (i, j), key in zip(S.runs(b), keys[1]):
            if key in set(keys[0]):
                covered.update(range(i, j + 1))
        assert len(covered) == len(S.sentences(passage))


def test_sentences_join_to_the_text():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b. ", "c!", "\n", " ", "? ", "…", '."', "é"]) for _ in range(40))
        assert "".join(S.sentences(text)) == text


def test_repeated_rows_and_empty(frame):
    text = " ".join(f"w{k}" for k in range(30)) + ". " + " ".join(f"v{k}" for k in range(30)) + "."
    rows = S.remove_repeats(frame([(1, text), (1, text), (2, text), (None, text)])).collect()
    assert {(r.doc_id, r.deduplicated.n_removed) for r in rows} == {(None, 0), (1, 2), (2, 2)}
    assert S.remove_repeats(frame([])).count() == 0


def test_texts_without_ids_or_with_one_id_lose_what_they_share(frame):
    """Of several texts with the smallest doc_id one keeps a passage; the others, and later ids, lose it."""
    rng = random.Random(5)
    passage = "The first sentence of a passage of some length is here. And so is the second one, with a few more words in it."
    for ids, later in (((None, None, None), 4), ((3, 3, 3), 9)):
        pairs = [(i, f"{prose(rng, 3)} {passage} {prose(rng, 3)}") for i in ids] + [(later, passage)]
        rows = S.remove_repeats(frame(pairs + pairs[:1])).collect()
        gone = sorted(r.deduplicated.n_removed for r in rows if r.doc_id == ids[0])
        copies = [r.deduplicated.n_removed for r in rows if r.text == pairs[0][1]]
        assert len(copies) == 2 and len(set(copies)) == 1
        assert sorted({(r.text, r.deduplicated.n_removed) for r in rows if r.doc_id == ids[0]}, key=lambda x: x[1])[0][1] == 0
        assert len({r.text for r in rows if r.doc_id == ids[0] and not r.deduplicated.n_removed}) == 1 and set(gone) == {0, 2}
        assert [r.deduplicated.n_removed for r in rows if r.doc_id == later] == [2]
