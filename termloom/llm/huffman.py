"""Token ids as files of canonical, length-limited Huffman codes.

Tokenised rows are counted once over all documents; the counts give code lengths of at
most ``max_bits`` (package-merge) and with them canonical codes.  A table of blocks holds
the coded ids of whole documents in ascending order: bits, the number of ids of each
document, and a checkpoint (a bit offset) every ``CHECKPOINT`` ids.  A block is decoded
alone: all its checkpoints advance together through one lookup table.

File format: a Parquet table ``blocks`` (one row a block, see ``BLOCK_SCHEMA``) and a
table ``code`` with the code length of every id, zero for ids that do not occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import wordids
from termloom.llm.common import give_back_memory, map_batches, parallelism, range_bounds, range_of
from termloom.session import new_path, small_batches, stage

END = 0
BLOCK_IDS = 1 << 18
CHECKPOINT = 128
MAX_BITS = 16
BLOCK_SCHEMA = (
    "part int, block long, start long, doc_ids array<bigint>, sizes array<bigint>,"
    " bits binary, checkpoints binary"
)


# Code lengths and codes


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; 0 for unused ids.

    More symbols than ``2 ** max_bits`` raise the limit to what they need.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.int64)
    n = len(leaf)
    levels, weights = [], leaf
    for _ in range(max_bits - 1):
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaf, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)  # which entries are leaves, not packages
        weights = merged[rank]
    take, depth = 2 * n - 2, np.zeros(n, dtype=np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    depth[:take] += 1
    lengths[order] = depth
    return lengths


@dataclass
class Code:
    """Canonical codes and the table that decodes them."""

    lengths: np.ndarray
    codes: np.ndarray
    max_bits: int
    ids: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(lengths: np.ndarray) -> Code:
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        size = lengths[order].astype(np.int64)
        max_bits = int(size.max(initial=1))
        room = np.int64(1) << (max_bits - size)
        first = np.cumsum(room) - room
        codes = np.zeros(len(lengths), dtype=np.uint64)
        codes[order] = (first >> (max_bits - size)).astype(np.uint64)
        ids = np.zeros(1 << max_bits, dtype=np.uint32)
        sizes = np.ones(1 << max_bits, dtype=np.uint8)
        ids[: room.sum()] = np.repeat(order, room)
        sizes[: room.sum()] = np.repeat(size, room)
        return Code(lengths, codes, max_bits, ids, sizes)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(bits, checkpoints) of ids; codes are at most 32 bits long."""
        if not len(ids):
            return b"", b""
        size = self.lengths[ids].astype(np.int64)
        end = np.cumsum(size)
        at = end - size
        word = at >> 5
        shifted = self.codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
        firsts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        # Codes do not overlap, so sums are bitwise ors; each reaches into one more word.
        sums = np.add.reduceat(shifted, firsts)
        out = np.zeros(int(end[-1] >> 5) + 2, dtype=np.uint32)
        out[word[firsts]] = (sums >> np.uint64(32)).astype(np.uint32)
        out[word[firsts] + 1] |= (sums & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return out.astype(">u4").tobytes(), at[::CHECKPOINT].astype("<u4").tobytes()

    def decode(self, bits: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of a block, all checkpoints in step."""
        at = np.frombuffer(checkpoints, dtype="<u4").astype(np.int64)
        words = np.append(np.frombuffer(bits, dtype=">u4").astype(np.uint64), np.zeros(2, np.uint64))
        words = ((words[:-1] << np.uint64(32)) | words[1:]).astype(np.uint64)
        out = np.empty((CHECKPOINT, len(at)), dtype=np.uint32)
        down = np.uint64(64 - self.max_bits)
        last = len(words) - 1
        for k in range(CHECKPOINT):
            place = np.minimum(at >> 5, last)
            window = (words[place] << (at & 31).astype(np.uint64)) >> down
            window = window.astype(np.int64)
            out[k] = self.ids[window]
            at += self.sizes[window]
        return out.T.reshape(-1)[:n]


# Tokens


def tokenize(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every row: ids of four bytes each, the end id appended."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = wordids.encoder(tokenizer)
        step = np.dtype(ids.wide).itemsize
        end_id = np.array([END], dtype=ids.wide).tobytes()
        for first, end, found in ids.encode_column(batch.column(1)):
            rows = [raw + end_id for raw in found]
            yield {
                "doc_id": batch.column(0).slice(first, end - first),
                "n_tokens": [len(r) // step for r in rows],
                "wide": [step] * len(rows),
                "ids": rows,
            }

    return map_batches(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")),
        "doc_id bigint, n_tokens bigint, wide int, ids binary",
        work,
    )


def _ids(raw: bytes, wide: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{wide}")


def id_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows; its length is bounded by the vocabulary."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw, wide in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = np.bincount(_ids(raw, wide))
                if len(one) > len(total):
                    total = np.append(total, np.zeros(len(one) - len(total), dtype=np.int64))
                total[: len(one)] += one
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])
        give_back_memory()

    found = tokens.select("ids", "wide").mapInArrow(partial, "id bigint, n bigint")
    with small_batches(tokens.sparkSession):
        rows = found.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.int64)
    counts[[r["id"] for r in rows]] = [r["n"] for r in rows]
    return counts


def write_ids(docs: DataFrame, tokenizer: str, path: str, text: str = "text") -> None:
    """Write the ids of all documents below ``path`` in ascending order of doc_id.

    Null and empty texts are the end id alone.  Null ids come first; rows that share an
    id stand side by side.  Extra columns are ignored; an empty table gives no block.
    """
    spark = docs.sparkSession
    tokens = stage(tokenize(docs, tokenizer, text), "ids-tokens")
    code = Code.of(code_lengths(id_counts(tokens)))
    bounds = range_bounds(tokens, "doc_id", 2 * parallelism(spark))
    parted = tokens.withColumn("part", range_of("doc_id", bounds).cast("int"))
    sums = parted.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one row a range
    before, total = {}, 0
    for row in sorted(sums, key=lambda r: r["part"]):
        before[row["part"]] = total
        total += row["n"]
    shared = spark.sparkContext.broadcast((code, before))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, before = shared.value
        part, block, start, held, n = None, 0, 0, [], 0

        def done() -> pa.RecordBatch:
            bits, checkpoints = code.encode(np.concatenate([ids for _, ids in held]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([start], pa.int64()),
                    pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                    pa.array([[len(ids) for _, ids in held]], pa.list_(pa.int64())),
                    pa.array([bits], pa.binary()), pa.array([checkpoints], pa.binary()),
                ],
                names=["part", "block", "start", "doc_ids", "sizes", "bits", "checkpoints"],
            )

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(4))
            for at, doc_id, wide, raw in zip(*columns, strict=True):
                if held and (at != part or n >= BLOCK_IDS):
                    yield done()
                    block, start, held, n = block + 1, start + n, [], 0
                if at != part:
                    part, block, start = at, 0, before[at]
                ids = _ids(raw, wide)
                held.append((doc_id, ids))
                n += len(ids)
        if held:
            yield done()
        give_back_memory()

    slim = parted.select("part", "doc_id", "wide", "ids")
    ordered = slim.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id")
    with small_batches(spark):
        ordered.mapInArrow(encode, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    lengths = [(int(i), int(code.lengths[i])) for i in np.flatnonzero(code.lengths)]
    spark.createDataFrame(lengths or [(0, 1)], "id int, bits int").coalesce(1).write.parquet(f"{path}/code")


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """The documents of a written folder: (doc_id, start, n_tokens) and their ids.

    ``digest`` gives the CRC-32 of the little-endian 32-bit ids, ``ids_crc32``, in place
    of the ids themselves.
    """
    rows = spark.read.parquet(f"{path}/code").collect()  # at most one row an id
    lengths = np.zeros(max(r["id"] for r in rows) + 1, dtype=np.uint8)
    lengths[[r["id"] for r in rows]] = [r["bits"] for r in rows]
    shared = spark.sparkContext.broadcast(lengths)
    codes: dict[str, Code] = {}

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        code = codes.setdefault("code", Code.of(shared.value))
        for row in range(len(batch)):  # a block is large: one at a time leaves Arrow
            start, doc_ids, sizes, bits, checkpoints = (batch.column(k)[row].as_py() for k in range(5))
            sizes = np.array(sizes, dtype=np.int64)
            ids = code.decode(bits, checkpoints, int(sizes.sum())).astype("<u4")
            ends = np.cumsum(sizes)
            parts = [ids[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
            out = {"doc_id": doc_ids, "start": start + ends - sizes, "n_tokens": sizes}
            if digest:
                yield out | {"ids_crc32": [zlib.crc32(p.tobytes()) for p in parts]}
            else:
                yield out | {"ids": [p.tolist() for p in parts]}

    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    blocks = spark.read.parquet(f"{path}/blocks")
    return map_batches(
        blocks.select("start", "doc_ids", "sizes", "bits", "checkpoints"),
        f"doc_id bigint, start bigint, n_tokens bigint, {last}",
        work,
    )


def encoded(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Write the ids of ``docs`` to a new folder and read them back as digests."""
    path = new_path(docs.sparkSession, "ids")
    write_ids(docs, tokenizer, path, text)
    return read_ids(docs.sparkSession, path, digest=True)
