"""SentencePiece encoding and decoding by a max-plus parallel scan.

The best segmentation of a text maximises the sum of its pieces' scores. Over the max-plus semiring that is
a product of matrices: a chunk of text maps the scores of its entry states to those of its exit states. A
state at a chunk border is the number of characters by which a piece reaches over it, so a matrix has as
many rows and columns as the longest piece has characters. The matrices of a document's chunks are combined
associatively, which gives each chunk its entry and exit state, and every chunk is then backtraced alone.

Characters without a piece become byte pieces. No piece holds a blank after another character, so a border
right before a run of blanks has one state only; words are the chunks of ordinary text and are remembered.
Blanks stay blanks here: a literal U+2581 has no piece, becomes bytes and comes back as itself.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice.llm.common import col, fresh, stored

BLANK = "▁"
#: A score below any sum of real scores, and the cost of a character by its bytes.
NEVER = -1e300
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Characters of a chunk of a giant document; documents up to that length are one chunk.
CHUNK = 1 << 16
REMEMBERED = 100_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a serialised message: varints, fixed values and length-delimited parts."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at:at + size]
            at += size


class Pieces:
    """Vocabulary of a model file: normal pieces with scores, and the ids of byte pieces.

    Scores are used as they stand, as those of a unigram model, whatever trainer made the file.
    """

    def __init__(self, model: bytes):
        self.texts: list[str] = []
        self.kinds: list[int] = []
        self.byte_id: dict[int, int] = {}
        #: Tree of pieces: a node is [children by character, score or None, id].
        self.root: list = [{}, None, -1]
        self.longest, scores, self.unknown = 1, [], 0
        for number, value in _fields(model):
            if number != 1:
                continue
            piece, score, kind = "", 0.0, NORMAL
            for inner, x in _fields(value):
                if inner == 1:
                    piece = x.decode()
                elif inner == 2:
                    score = struct.unpack("<f", x)[0]
                elif inner == 3:
                    kind = x
            n = len(self.texts)
            self.texts.append(piece)
            self.kinds.append(kind)
            if kind == BYTE:
                self.byte_id[int(piece[1:-1], 16)] = n
            elif kind == UNKNOWN:
                self.unknown = n
            elif kind in (NORMAL, USER):
                scores.append(score)
                self.longest = max(self.longest, len(piece))
                node = self.root
                for c in piece.replace(BLANK, " "):
                    node = node[0].setdefault(c, [{}, None, -1])
                node[1], node[2] = score, n
        self.by_bytes = (min(scores) if scores else 0.0) - 10.0
        self.plain = [x.replace(BLANK, " ") for x in self.texts]
        whole = [x for x, k in zip(self.plain, self.kinds) if k in (NORMAL, USER)]
        #: Neighbours in some piece; between any other two characters lies a border of one state.
        self.pairs = {x[k - 1:k + 1] for x in whole for k in range(1, len(x))}
        self.word_wise = not any(b == " " and a != " " for a, b in self.pairs)
        for b, n in self.byte_id.items():
            if b < 128:  # a character by itself
                self.plain[n] = chr(b)
        self.is_special = np.array([k == CONTROL or k == BYTE and len(x) > 1 for k, x in zip(self.kinds, self.plain)], bool)
        self.memory: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def walk(self, text: str, ahead: list[float]) -> tuple[list[float], list[int], list[int]]:
        """Scores, last starts and last pieces by position; ``ahead`` are the scores of the first positions.

        Of equal scores the earliest start wins, as longer last pieces are met first. A position that no piece
        in the text reaches better than ``ahead`` says keeps start -1: it is an entry.
        """
        n = len(text)
        score, start, last = [NEVER] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        score[:len(ahead)] = ahead[:n + 1]
        children, by_bytes = self.root[0], self.by_bytes
        for i in range(n):
            here = score[i]
            if here == NEVER:
                continue
            node, j = children.get(text[i]), i + 1
            if node is None or node[1] is None:
                if here + by_bytes > score[j]:
                    score[j], start[j], last[j] = here + by_bytes, i, -1
            while node is not None:
                gain = node[1]
                if gain is not None and here + gain > score[j]:
                    score[j], start[j], last[j] = here + gain, i, node[2]
                if j == n:
                    break
                node = node[0].get(text[j])
                j += 1
        return score, start, last

    def ids_back(self, text: str, start: list[int], last: list[int], end: int) -> list[int]:
        """Ids of the best path from its entry to ``end``."""
        out: list[int] = []
        while (i := start[end]) >= 0:
            if last[end] >= 0:
                out.append(last[end])
            else:
                out += [self.byte_id.get(b, self.unknown) for b in reversed(text[i].encode())]
            end = i
        out.reverse()
        return out

    def word(self, text: str) -> bytes:
        """Ids of a word, as 32-bit integers. Words of the last two generations of the memory are known."""
        got = self.before.get(text)
        if got is not None:
            self.keep(text, got)
            return got
        parts = self.cut(text)
        if len(parts) == 1:
            return self.run(text)
        got = b"".join([self.memory.get(part) or self.run(part) for part in parts])
        self.keep(text, got)
        return got

    def cut(self, text: str) -> list[str]:
        """The text at its borders of one state."""
        at, out, pairs = 0, [], self.pairs
        for k in range(1, len(text)):
            if text[k - 1:k + 1] not in pairs:
                out.append(text[at:k])
                at = k
        out.append(text[at:])
        return out

    def run(self, text: str) -> bytes:
        _, start, last = self.walk(text, [0.0])
        got = np.array(self.ids_back(text, start, last, len(text)), np.int32).tobytes()
        self.keep(text, got)
        return got

    def keep(self, text: str, ids: bytes) -> None:
        if len(text) <= 40:
            if len(self.memory) >= REMEMBERED:
                self.before, self.memory = self.memory, {}
            self.memory[text] = ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, as 32-bit integers: a chain of words, each cut at its borders of one state.

        A blank is set before the text; an empty text has no ids.
        """
        if not text:
            return b""
        if not self.word_wise:
            return self.word(" " + text)
        word, known = self.word, self.memory.get
        if "  " not in text and "\0" not in text and text[0] != " " and text[-1] != " ":
            return b"".join([known(x) or word(x) for x in ("\0 " + text.replace(" ", "\0 ")).split("\0")[1:]])
        parts, run = [], ""
        for x in text.split(" "):
            run += " "
            if x:
                x = run + x
                parts.append(known(x) or word(x))
                run = ""
        if run:
            parts.append(word(run))
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: bytes joined, control pieces left out, the leading blank removed."""
        if not len(ids):
            return ""
        if not self.is_special[ids].any():
            return "".join(map(self.plain.__getitem__, ids.tolist()))[1:]
        out, raw = [], bytearray()
        for n in ids.tolist():
            if self.kinds[n] == BYTE:
                raw.append(int(self.texts[n][1:-1], 16))
                continue
            if raw:
                out.append(raw.decode())
                raw.clear()
            if self.kinds[n] != CONTROL:
                out.append(self.plain[n])
        if raw:
            out.append(raw.decode())
        return "".join(out)[1:]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read())


def transfer(p: Pieces, text: str, ahead: str) -> np.ndarray:
    """The chunk's matrix: [entry, exit], the characters by which a piece reaches over a border.

    ``ahead`` holds the characters behind the chunk that pieces starting in it may cover. All entries run side by
    side: the score of a position is a vector over entries.
    """
    width, n = p.longest, len(text)
    whole = text + ahead[:width - 1]
    m = len(whole)
    score = np.full((m + 1, width), NEVER)
    for e in range(min(width, n + 1)):
        score[e, e] = 0.0
    for i in range(n):
        here = score[i]
        node, j = p.root[0].get(whole[i]), i + 1
        if node is None or node[1] is None:
            np.maximum(score[j], here + p.by_bytes, out=score[j])
        while node is not None:
            if node[1] is not None:
                np.maximum(score[j], here + node[1], out=score[j])
            if j == m:
                break
            node = node[0].get(whole[j])
            j += 1
    out = np.full((width, width), NEVER)
    for x in range(min(width, m - n + 1)):
        out[:, x] = score[n + x]
    return np.maximum(out, NEVER)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: associative, so chunks can be combined in any grouping."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NEVER)


def chunk_matrix(p: Pieces, text: str, ahead: str) -> np.ndarray:
    """The chunk's matrix. Between its first and last border of one state every path has the same score, which is
    left out: only the head before and the tail behind have more than one state."""
    lone = lambda k: text[k - 1:k + 1] not in p.pairs
    first = next((k for k in range(p.longest, len(text)) if lone(k)), 0)
    last = next((k for k in range(len(text) - 1, first, -1) if lone(k)), 0) if first else 0
    if not last:
        return transfer(p, text, ahead)
    return combine(transfer(p, text[:first], "")[:, :1], transfer(p, text[last:], ahead)[:1])


def forward(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Scores of every chunk's entry states: the prefix products, applied to the document's start.

    Only differences between the states matter; the best one is set to 0.
    """
    out = [np.where(np.arange(matrices[0].shape[0]) == 0, 0.0, NEVER)]
    for m in matrices[:-1]:
        now = combine(out[-1][None, :], m)[0]
        out.append(np.where(now > NEVER / 2, now - now.max(), NEVER))
    return out


def walk_chunk(p: Pieces, text: str, whole: str, scores: np.ndarray) -> tuple[list[int], list[int]]:
    """Viterbi over the chunk and the characters ahead, where no piece starts behind the chunk."""
    n, more = len(text), len(whole) - len(text)
    score, start, last = p.walk(text, scores.tolist())
    score, start, last = score + [NEVER] * more, start + [-1] * more, last + [-1] * more
    for i in range(max(0, n - p.longest + 1), n):
        here, node, j = score[i], p.root[0].get(whole[i]), i + 1
        while node is not None and here > NEVER:
            if j > n and node[1] is not None and here + node[1] > score[j]:
                score[j], start[j], last[j] = here + node[1], i, node[2]
            if j == len(whole):
                break
            node = node[0].get(whole[j])
            j += 1
    return start, last


def choices(p: Pieces, text: str, ahead: str, scores: np.ndarray) -> list[int]:
    """For every exit state of the chunk the entry state that its best path comes from; -1 where no path ends."""
    whole = text + ahead[:p.longest - 1]
    start, _ = walk_chunk(p, text, whole, scores)
    found = []
    for x in range(p.longest):
        end = len(text) + x
        if end > len(whole) or x and start[end] < 0:
            found.append(-1)
            continue
        while start[end] >= 0:
            end = start[end]
        found.append(end)
    return found


def exits(maps: list[list[int]]) -> list[int]:
    """The exit state of every chunk: the maps from exit to entry, composed from the document's end."""
    out, leave = [], 0
    for m in reversed(maps):
        out.append(leave)
        leave = m[leave]
    return out[::-1]


def backtrace(p: Pieces, text: str, ahead: str, scores: np.ndarray, leave: int) -> np.ndarray:
    """Ids of the pieces that start in the chunk, given its entry scores and exit state."""
    whole = text + ahead[:p.longest - 1]
    start, last = walk_chunk(p, text, whole, scores)
    return np.array(p.ids_back(whole, start, last, len(text) + leave), np.int32)


def _encoder(path: str):
    """Ids, and whether they decode to the text again: both in one worker, so the ids need no second way to Python."""
    @F.pandas_udf(T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("same", T.BooleanType())]))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = vocabulary(path)
        for texts in batches:
            ids = [None if t is None else np.frombuffer(p.encode(t), np.int32) for t in texts]
            same = [t is None or p.decode(x) == t for t, x in zip(texts, ids)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "same": same})

    return encode


def _decoder(path: str):
    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        p = vocabulary(path)
        for rows in batches:
            yield pd.Series([None if r is None else p.decode(np.asarray(r)) for r in rows], dtype=object)

    return decode


def _chunk_tools(path: str):
    @F.pandas_udf(T.BinaryType())
    def matrix(texts: pd.Series, aheads: pd.Series) -> pd.Series:
        p = vocabulary(path)
        return pd.Series([chunk_matrix(p, t, a).tobytes() for t, a in zip(texts, aheads)], dtype=object)

    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def scores(matrices: pd.Series) -> pd.Series:
        width = vocabulary(path).longest
        return pd.Series([[v.tobytes() for v in forward([np.frombuffer(m, float).reshape(width, width) for m in ms])]
                          for ms in matrices], dtype=object)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def back(texts: pd.Series, aheads: pd.Series, ahead_scores: pd.Series) -> pd.Series:
        p = vocabulary(path)
        return pd.Series([choices(p, t, a, np.frombuffer(v, float)) for t, a, v in zip(texts, aheads, ahead_scores)], dtype=object)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def leave(maps: pd.Series) -> pd.Series:
        return pd.Series([exits([list(m) for m in ms]) for ms in maps], dtype=object)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def trace(texts: pd.Series, aheads: pd.Series, ahead_scores: pd.Series, exit_states: pd.Series) -> pd.Series:
        p = vocabulary(path)
        return pd.Series([backtrace(p, t, a, np.frombuffer(v, float), int(x))
                          for t, a, v, x in zip(texts, aheads, ahead_scores, exit_states)], dtype=object)

    return matrix, scores, back, leave, trace


def encode_pieces(docs: DataFrame, model: str, text: str = "text", out: str = "ids", chunk: int = CHUNK,
                  same: str = "same") -> DataFrame:
    """The frame with two more columns, the ids of each whole text and whether they decode to it (true for null);
    ``model`` is a path every executor can open.

    Null text gives null, empty text an empty array. Texts over ``chunk`` characters (at least the longest piece) are
    encoded chunk by chunk on many tasks, with equal ids; of them only a small matrix and a small map per chunk are
    gathered for each document. Repeated rows are encoded each on its own; an empty table gives an empty table;
    ``out`` and ``same`` get a number where the frame has such a column.
    """
    name, same, made = fresh(docs, out, same, "encoded_struct")
    giant_length = F.coalesce(F.char_length(col(text)) > chunk, F.lit(False))
    small = docs.where(~giant_length).withColumn(made, _encoder(model)(col(text)))
    small = small.select(*[col(c) for c in docs.columns], F.col(f"{made}.ids").alias(name), F.col(f"{made}.same").alias(same))
    giant = docs.where(giant_length)
    if giant.isEmpty():
        return small
    matrix, scores, back, leave, trace = _chunk_tools(model)
    width = vocabulary(model).longest
    key, = fresh(docs, "giant_row")
    giant = stored(giant.withColumn(key, F.monotonically_increasing_id()), "giant")
    cut = giant.select(F.col(key).alias("k"), F.concat(F.lit(" "), col(text)).alias("whole"),
                       F.posexplode(F.sequence(F.lit(0), F.char_length(col(text)), F.lit(chunk))).alias("c", "at"))
    cut = stored(cut.select("k", "c", F.expr(f"substring(whole, at + 1, {chunk})").alias("t"),
                            F.expr(f"substring(whole, at + 1 + {chunk}, {width})").alias("a")).repartition("k", "c"), "chunks")

    def per_document(df: DataFrame, gather, value: str) -> DataFrame:
        """One value per chunk gathered, in chunk order, for a function of the document; its results by chunk."""
        whole = df.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("c", value))).alias("all"))
        return whole.select("k", F.posexplode(gather(f"all.{value}")).alias("c", "got"))

    ahead = stored(per_document(cut.select("k", "c", matrix("t", "a").alias("m")), scores, "m")
                   .withColumnRenamed("got", "v"), "scores")
    maps = cut.join(ahead, ["k", "c"]).select("k", "c", back("t", "a", "v").alias("m"))
    ends = per_document(maps, leave, "m").withColumnRenamed("got", "x")
    ids = cut.join(ahead, ["k", "c"]).join(ends, ["k", "c"]).select("k", "c", trace("t", "a", "v", "x").alias("i")) \
        .groupBy("k").agg(F.sort_array(F.collect_list(F.struct("c", "i"))).alias("all")) \
        .select("k", F.flatten("all.i").alias(name))
    joined = giant.join(ids, F.col(key) == F.col("k"))
    decoded = _decoder(model)(F.col(name))
    return small.unionByName(joined.select(*[col(c) for c in docs.columns], name, (decoded == col(text)).alias(same)))


def decode_pieces(encoded: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with one more column, the text of the ids; null ids give null."""
    return encoded.withColumn(fresh(encoded, out)[0], _decoder(model)(col(ids)))
