"""Training-order materialisation: token sequences in fixed-stride binary shards.

The token streams of the input partitions, one after the other, are cut into sequences of one length. A keyed
Feistel network with cycle walking permutes the sequence numbers: that is each sequence's global slot. Ranges of
slots are shards; a shard is a binary file in which slot s starts at (s - first slot) * stride, so a reader can
start, stop and resume at any slot.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice.llm.common import col, new_folder, row_type, stored

#: The published pre-tokenisation pattern of the 50k byte-level vocabulary. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same alternatives in the same order, those before the lookahead as one group, which the library matches at once.
AHEAD = r"|\s+(?!\S)|\s+"
GROUPED = f"(?:{PATTERN.removesuffix(AHEAD)}){AHEAD}"
LENGTH, SHARD_SLOTS, ROUNDS = 1024, 8192, 8
#: The end token's name. Only its id is written after a text; a text that holds the name keeps it as plain characters.
END = "<|endoftext|>"


class Tokens:
    """Ids of texts as bytes of one integer type. The library takes whole texts: no step of Python's for a word."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = max(ranks.values()) + 1
        self.kind = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self.encoding = tiktoken.Encoding("words", pat_str=GROUPED, mergeable_ranks=ranks, special_tokens={END: self.end})

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def encode(self, text: str | None) -> bytes:
        """Ids of the text and the end token; null and empty texts give nothing."""
        if not text:
            return b""
        return self.ids(text).astype(self.kind).tobytes() + self.end.to_bytes(self.kind.itemsize, "little")

    def count(self, text: str | None) -> int:
        """How many ids ``encode`` gives."""
        return self.ids(text).size + 1 if text else 0


@lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    return Tokens(path)


def feistel(x: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0..n-1, by cycle walking: a value outside is permuted again until it falls inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{k}".encode(), digest_size=8).digest(), "little")) for k in range(rounds)]

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(31)) & mask)
        return (left << np.uint64(half)) | right

    out = once(x.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _count(path: str):
    schema = pa.schema([("part", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, n, part = tokens_of(path), 0, None
        for batch in batches:
            part = batch.column(0)[0].as_py() if batch.num_rows and part is None else part
            n += sum(map(tokens.count, batch.column(2).to_pylist()))
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64())], schema=schema)

    return run


SEQUENCE = "shard int, slot long, n_tokens int, doc_ids array<long>, body binary"


def _cut(path: str, first: dict[int, int], total: int, length: int, key: int, shard_slots: int):
    types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
    names = [f.split()[0] for f in SEQUENCE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = tokens_of(path), zstandard.ZstdCompressor(level=1)
        size, number = tokens.kind.itemsize, None
        stride, tail, docs = length * size, b"", []

        def emit(rows: list[tuple[bytes, list]]) -> pa.RecordBatch:
            nonlocal number
            slots = feistel(np.arange(number, number + len(rows)), total, key)
            number += len(rows)
            pad = tokens.end.to_bytes(size, "little")
            body = [packer.compress(b + pad * (length - len(b) // size)) for b, _ in rows]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                (slots // shard_slots, slots, [len(b) // size for b, _ in rows], [d for _, d in rows], body), types)], names=names)

        for batch in batches:
            if batch.num_rows and number is None:
                number = first[batch.column(0)[0].as_py()]
            rows = []
            for doc, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = tokens.encode(text)
                if not ids:
                    continue
                tail += ids
                docs.append(doc)
                at = 0
                while len(tail) - at >= stride:
                    rows.append((tail[at:at + stride], docs))
                    at += stride
                    docs = [doc] if len(tail) > at else []
                tail = tail[at:]
                if len(rows) >= 2000:
                    yield emit(rows)
                    rows = []
            if rows:
                yield emit(rows)
        if tail:
            yield emit([(tail, docs)])

    return run


WRITTEN = "slot long, shard int, byte_offset long, n_tokens int, doc_ids array<long>, sha256 string"


def _write(folder: str, stride: int, shard_slots: int):
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.string()]
    names = [f.split()[0] for f in WRITTEN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        unpacker, now, out, draft = zstandard.ZstdDecompressor(), None, None, ""

        def close() -> None:
            if out is not None:
                out.close()
                fs.move(draft, f"{root}/shard-{now:08d}.bin")  # a second attempt writes the same bytes

        for batch in batches:
            rows = []
            for shard, slot, n, docs, body in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if shard != now:
                    close()
                    now, draft = shard, f"{root}/draft-{uuid4().hex}"
                    out = fs.open_output_stream(draft)
                raw = unpacker.decompress(body, max_output_size=stride)
                out.write(raw)
                rows.append((slot, shard, (slot - shard * shard_slots) * stride, n, docs, hashlib.sha256(raw).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        close()

    return run


def write_shards(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", folder: str | None = None,
                 length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = 20240501) -> DataFrame:
    """Writes the shards and returns their index: one row per slot with its shard, byte offset, number of real
    tokens, the documents it holds tokens of, and the digest of its bytes.

    ``docs`` has to give the same rows in the same partitions whenever it is read, as a table of files does (use
    ``stored`` otherwise): partitions are read twice, once to count tokens, once to cut them; the order of the stream
    is that of the partitions and their rows. Only one count per partition reaches the driver. The last sequence of
    a partition is padded with the end token. Null and empty texts have no tokens, repeated rows are written again,
    a null doc_id is a null in doc_ids. Without any token there are no rows and no files. ``folder`` is a URI that
    driver and executors share, a new one in the shared folder by default.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "shards")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    fs, root = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    slim = docs.select(F.spark_partition_id().alias("part"), col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    counts = slim.mapInArrow(_count(tokenizer), row_type("part int, n long")).collect()
    first, total = {}, 0
    for r in sorted(counts):
        first[r.part] = total
        total += -(-r.n // length)
    stride = length * tokens_of(tokenizer).kind.itemsize
    cut = slim.mapInArrow(_cut(tokenizer, first, total, length, key, shard_slots), row_type(SEQUENCE))
    # Ranges of whole shards, as even as can be: slots are a permutation, so their ranges are known without a sample.
    shards = -(-total // shard_slots)
    ranges = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), shards))
    in_order = cut.repartitionById(ranges, F.floor(F.col("shard").cast("long") * ranges / max(1, shards)).cast("int")).sortWithinPartitions("slot")
    return stored(in_order.mapInArrow(_write(folder, stride, shard_slots), row_type(WRITTEN)), "shard-index")


def read_slots(folder: str, start: int, stop: int, length: int = LENGTH, shard_slots: int = SHARD_SLOTS,
               kind: str = "<u2") -> Iterator[np.ndarray]:
    """The sequences of slots start..stop-1 in training order: seeks to the first and reads on."""
    fs, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    stride = length * np.dtype(kind).itemsize
    slot = start
    while slot < stop:
        shard = slot // shard_slots
        with fs.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            f.seek((slot - shard * shard_slots) * stride)
            while slot < min(stop, (shard + 1) * shard_slots):
                raw = f.read(stride)
                if len(raw) < stride:
                    return
                yield np.frombuffer(raw, kind)
                slot += 1
