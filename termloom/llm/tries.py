"""Repeated texts by compressed radix tries over ranges of the text order.

A task first inserts its own documents into a trie, which answers for all but the smallest
id of each text at once; only those, with their texts, are dealt out.  The order of texts is
cut into ranges at prefixes that are as long as neighbouring texts need to differ, so texts
that share a long beginning part behind it.  A range is one trie: its terminals hold the
smallest id of a text, and a walk over the terminals flags the others.

A text that a third of all rows share is one row per task when it is dealt out, and the
rows already answered for travel without their texts.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import give_back_memory, parallelism

#: Text of a trie: distinct bytes in a task's own one, bytes of a range on average.
LOCAL_BYTES = 32 << 20
RANGE_BYTES = 64 << 20
#: Ranges there can be: their prefixes, some 20 bytes each, are sent to every executor.
MAX_RANGES = 1 << 20
#: Ranges a task works through, one after another, where there are more than cores.
RANGES_PER_TASK = 8
#: Sampled texts from one range to the next; they only say where ranges begin.
SAMPLE_STEP = 16
#: Rows without an id come after all others.
NO_ID = 1 << 63
#: Text bytes in one outgoing batch, and rows.
OUT_BYTES, OUT_ROWS = 4 << 20, 10_000

DEALT = "doc_id bigint, part string, mask int, n bigint, text binary, range int"
FLAGGED = "doc_id bigint, part string, mask int, n bigint"


class Node:
    """A point of the trie: ``text[:end]`` leads to it, ``text[start:end]`` from its parent."""

    __slots__ = ("children", "end", "least", "rows", "start", "text")

    def __init__(self, text: bytes, start: int, end: int) -> None:
        self.text, self.start, self.end = text, start, end
        self.children: dict[int, Node] = {}
        self.least: int | None = None  # the smallest id of a text that ends here
        self.rows: list | None = None


def shared(a: bytes, i: int, b: bytes, j: int, most: int) -> int:
    """How many bytes from a[i] and b[j] on are equal, at most ``most``."""
    low, step = 0, 32
    while low + step <= most and a[i + low : i + low + step] == b[j + low : j + low + step]:
        low += step
        step *= 2
    high = min(low + step, most)
    while low < high:
        middle = (low + high + 1) // 2
        if a[i + low : i + middle] == b[j + low : j + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node, text: bytes) -> Node:
    """The node at which ``text`` ends, made where there is none."""
    node, at, n = root, 0, len(text)
    while at < n:
        child = node.children.get(text[at])
        if child is None:
            leaf = node.children[text[at]] = Node(text, at, n)
            return leaf
        size = child.end - child.start
        if size <= n - at and text[at : at + size] == child.text[child.start : child.end]:
            node, at = child, at + size
            continue
        k = shared(text, at, child.text, child.start, min(size, n - at))
        middle = Node(child.text, child.start, child.start + k)
        middle.children[child.text[middle.end]] = child
        node.children[text[at]] = middle
        child.start = middle.end
        node, at = middle, at + k
    return node


def terminals(root: Node) -> Iterator[Node]:
    """All nodes at which a text ends."""
    stack = [root]
    while stack:
        node = stack.pop()
        if node.rows is not None:
            yield node
        stack.extend(node.children.values())


def text_bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def batches_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded text."""
    wide = "text" in names
    first, held = 0, 0
    for end, row in enumerate(rows, 1):
        held += len(row[4] or b"") if wide else 0
        if held >= OUT_BYTES or end - first >= OUT_ROWS or end == len(rows):
            columns = zip(*rows[first:end], strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)
            first, held = end, 0


DEALT_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int32()]
DEALT_NAMES = ["doc_id", "part", "mask", "n", "text", "range"]


def _deal(sent, ranges: int, repeated: int):
    """Insert a task's documents; answer for repeats, deal out the smallest id of each text."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = sent.value
        root, held, out = Node(b"", 0, 0), 0, []
        turn = 0

        def answered(i: int, part: str, mask: int, n: int) -> tuple:
            nonlocal turn
            turn = (turn + 1) % ranges  # spread over the ranges
            return (None if i == NO_ID else i, part, mask | repeated, n, None, turn)

        def dealt() -> Iterator[tuple]:
            for node in terminals(root):
                text = node.text[: node.end]
                where = bisect_right(starts, text)
                mask, counts = node.rows
                i = None if node.least == NO_ID else node.least
                for part, n in counts.items():
                    yield (i, part, mask, n, text, where)

        for batch in batches:
            columns = zip(
                batch["doc_id"].to_pylist(), batch["part"].to_pylist(),
                batch["mask"].to_pylist(), text_bytes(batch["text"]), strict=True,
            )
            for i, part, mask, text in columns:
                i = NO_ID if i is None else i
                node = insert(root, text)
                if node.rows is None:
                    node.least, node.rows = i, (mask, {part: 1})
                    held += len(text) + 500
                elif i > node.least:
                    out.append(answered(i, part, mask, 1))
                elif i == node.least:
                    counts = node.rows[1]
                    counts[part] = counts.get(part, 0) + 1
                else:
                    out += [answered(node.least, p, mask, n) for p, n in node.rows[1].items()]
                    node.least, node.rows = i, (mask, {part: 1})
                if held >= LOCAL_BYTES:
                    yield from batches_of(list(dealt()), DEALT_NAMES, DEALT_TYPES)
                    root, held = Node(b"", 0, 0), 0
            yield from batches_of(out, DEALT_NAMES, DEALT_TYPES)
            out = []
        yield from batches_of(list(dealt()), DEALT_NAMES, DEALT_TYPES)
        give_back_memory()

    return deal


def _flag(repeated: int):
    """One trie per range, rows coming range by range: flag all but the smallest id."""

    def walk(root: Node) -> list[tuple]:
        return [
            (None if i == NO_ID else i, part, mask | repeated if i > node.least else mask, n)
            for node in terminals(root)
            for i, part, mask, n in node.rows
        ]

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = DEALT_NAMES[:4], DEALT_TYPES[:4]
        root, now = Node(b"", 0, 0), None
        for batch in batches:
            out = []
            texts = batch["text"].cast(pa.large_binary()).to_pylist()
            columns = zip(*(batch[c].to_pylist() for c in (*names, "range")), texts, strict=True)
            for i, part, mask, n, where, text in columns:
                if where != now:
                    out += walk(root)
                    root, now = Node(b"", 0, 0), where
                if text is None:
                    out.append((i, part, mask, n))
                    continue
                i = NO_ID if i is None else i
                node = insert(root, text)
                if node.rows is None:
                    node.least, node.rows = i, []
                node.least = min(node.least, i)
                node.rows.append((i, part, mask, n))
            yield from batches_of(out, names, types)
        yield from batches_of(walk(root), names, types)
        give_back_memory()

    return flag


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ordered texts, every so many a prefix that parts it from the one before it."""
    before, k, found = None, 0, []
    last = None
    for batch in batches:
        for text in text_bytes(batch["text"]):
            k += 1
            if before is not None and before != text:
                last = text[: len(os.path.commonprefix([before, text])) + 1]
                if k % SAMPLE_STEP == SAMPLE_STEP // 2:
                    found.append(last)
            before = text
    if not found and last is not None:  # a short part of the sample marks one range too
        found.append(last)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["start"])


def range_starts(texts: DataFrame, rows: int, ranges: int) -> list[bytes]:
    """Ascending prefixes at which the ranges begin, from a sample of texts.

    The sample decides how even the ranges are, never which rows are compared.
    """
    if ranges < 2:
        return []
    share = min(1.0, SAMPLE_STEP * ranges / max(rows, 1))
    sample = texts.select(F.coalesce("text", F.lit("")).alias("text")).sample(share, seed=7).distinct()
    ordered = sample.repartitionByRange(F.substring("text", 1, 64)).sortWithinPartitions("text")
    found = ordered.mapInArrow(_starts, "start binary").collect()
    return sorted({bytes(r["start"]) for r in found})


def flag_repeats(docs: DataFrame, repeated: int) -> DataFrame:
    """(doc_id, part, mask, n): ``repeated`` is set in the mask of a document whose text a
    smaller id has; equal rows may come as one with their number.

    ``docs`` has doc_id, part, mask and text, the mask a function of the text.  A null text
    is empty; a row without an id comes after all others.
    """
    spark = docs.sparkSession
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    total = size["bytes"] or 0
    starts = range_starts(docs, size["rows"], min(MAX_RANGES, total // RANGE_BYTES + parallelism(spark)))
    ranges = len(starts) + 1
    tasks = min(ranges, max(parallelism(spark), -(-ranges // RANGES_PER_TASK)))
    sent = spark.sparkContext.broadcast(starts)
    dealt = docs.select("doc_id", "part", "mask", "text").mapInArrow(_deal(sent, ranges, repeated), DEALT)
    by_range = dealt.repartitionById(
        tasks, F.floor(F.col("range") * F.lit(tasks) / F.lit(ranges)).cast("int")
    )
    return by_range.sortWithinPartitions("range").mapInArrow(_flag(repeated), FLAGGED)


def trie_size(root: Node) -> tuple[int, int]:
    """(nodes, label bytes): what a compressed trie holds beside the texts themselves."""
    stack, nodes, held = [root], 0, 0
    while stack:
        node = stack.pop()
        nodes, held = nodes + 1, held + node.end - node.start
        stack.extend(node.children.values())
    return nodes, held


def least_ids(texts: list[tuple[int, bytes]]) -> np.ndarray:
    """For each (id, text) the smallest id of its text, by one trie."""
    root = Node(b"", 0, 0)
    ends = []
    for i, text in texts:
        node = insert(root, text)
        node.least = i if node.least is None else min(node.least, i)
        ends.append(node)
    return np.array([node.least for node in ends], dtype=np.int64)
