"""Repeated substrings across documents, by external induced suffix sorting.

A byte goes when it is covered by a ``SPAN``-byte string that also starts in a document
of smaller id.  Equal strings contain the same sampled position (the least hash of their
``GRAM``-byte pieces), so the snippets with a sampled piece that occurs in more than one text are
all that has to be compared.  Snippets meet by the hash of that piece;
equal snippets are one before they move.  Each shard of snippets is sorted by its
suffixes (``inducedsort``), and in every run of suffixes with a common prefix of ``SPAN``
bytes the smallest document id is what the others are held against.  A piece with more snippets than
a shard is for is split: the strings of its snippets are rows of their own and meet by value.

Equal texts are one text first: all but the copy of the smallest id go whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import (
    BASE_INVERSE,
    _power_table,
    map_batches,
    mix,
    pieces,
    prefix_sums,
    small_side,
    span_hashes,
)
from termloom.llm.inducedsort import sorted_suffixes
from termloom.session import delete_path, dropped_shuffles, stage, stage_outside, stage_parts, staging

SPAN = 50
GRAM = 20
#: Text of one shard: the sort keeps some hundred bytes a byte in numpy arrays.
SHARD_BYTES = 1_500_000
#: Shards of snippets that one task is dealt, before those that need no sort are left out.
DEALT_SHARDS = 1.5
#: Shared pieces that tasks may hold as a table of bits; more of them are joined.
MAX_SHARED = 40_000_000
#: Bits of that table for each shared piece, the bits a piece marks, and the bits of a block.
SIEVE_BITS = 12
SIEVE_MARKS = 4
SIEVE_BLOCK = 1 << 16
#: Parts that snippets are worked on one after the other, so that the shuffles and tables of one
#: lie on disk at a time; fewer where a part would have less than so many shared pieces.
PARTS = 8
PART_PIECES = 1_000_000
#: Groups of pieces whose bytes are summed first, to find those that hold an oversized piece.
BUCKETS = 1 << 16
#: What tells snippets apart in joins: two hashes of 64 bits, of a piece and of all bytes.
KEYS = ["piece", "snippet_key"]
#: Strings of one batch out of an oversized piece.
STRINGS = 1 << 14


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every window of ``width`` values."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def sampled(
    data: np.ndarray, offsets: np.ndarray, span: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, hash) of the runs of neighbouring ``span``-byte strings of a text whose
    least piece hash is the same; every such string is in one run, by its start."""
    n, reach = len(data), span - gram + 1
    if n < span:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    sums = prefix_sums(data)
    down = _power_table("down", BASE_INVERSE, n + 1)
    hashes = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    least = _slide(hashes, reach, np.minimum)
    inside = np.zeros(n + 1, dtype=np.int8)
    starts, ends = offsets[:-1], offsets[1:]
    ok = ends - starts >= span
    np.add.at(inside, starts[ok], 1)
    np.subtract.at(inside, ends[ok] - span + 1, 1)
    valid = np.cumsum(inside, dtype=np.int8)[: len(least)] > 0
    change = least[1:] != least[:-1]
    change |= valid[1:] != valid[:-1]
    change[starts[(starts > 0) & (starts < len(least))] - 1] = True
    first = np.append(0, np.flatnonzero(change) + 1)
    end = np.append(first[1:], len(least))
    keep = valid[first]
    return first[keep], end[keep], least[first[keep]]


def _of_rows(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, side="right") - 1


def piece_counts(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(piece, n): in how many texts each sampled piece occurs."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for _, _, data, offsets in pieces(batch.column(0)):
            places, _, hashes = sampled(data, offsets, span, gram)
            row = _of_rows(places, offsets)
            order = np.lexsort((hashes, row))
            row, hashes = row[order], hashes[order]
            new = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))[: len(row)]
            yield {"piece": hashes[new].view(np.int64)}

    found = map_batches(texts.select("text"), "piece bigint", work)
    return found.groupBy("piece").agg(F.count("*").alias("n"))


def _marks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The block of each piece and its bits there.  Pieces are least hashes, so mixed again."""
    bits = mix(hashes ^ BASE_INVERSE)
    marks = [(bits >> np.uint64(16 * k)) % np.uint64(SIEVE_BLOCK) for k in range(SIEVE_MARKS)]
    return (mix(bits) % np.uint64(blocks)).astype(np.int64), [at.astype(np.int64) for at in marks]


def sieve(shared: DataFrame, n: int) -> np.ndarray:
    """A table of bits (blocks, bytes) that knows all ``n`` pieces of ``shared`` and few others."""
    blocks = n * SIEVE_BITS // SIEVE_BLOCK + 1

    def deal(batch: pa.RecordBatch) -> Iterator[dict]:
        hashes = np.asarray(batch.column(0), dtype=np.int64).view(np.uint64)
        yield {"block": _marks(hashes, blocks)[0], "piece": batch.column(0)}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, held = np.full(blocks, -1), np.zeros((0, SIEVE_BLOCK), dtype=bool)
        for batch in batches:
            block, marks = _marks(np.asarray(batch.column(1), dtype=np.int64).view(np.uint64), blocks)
            new = np.unique(block[places[block] < 0])
            if len(new):
                places[new] = len(held) + np.arange(len(new))
                held = np.concatenate([held, np.zeros((len(new), SIEVE_BLOCK), dtype=bool)])
            for at in marks:
                held[places[block], at] = True
        for b in np.flatnonzero(places >= 0).tolist():
            bits = np.packbits(held[places[b]], bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int64()), "bits": pa.array([bits])})

    with dropped_shuffles(shared.sparkSession):
        dealt = map_batches(shared.select("piece"), "block bigint, piece bigint", deal)
        parts = dealt.repartition(blocks // 128 + 1, "block").mapInArrow(fill, "block bigint, bits binary").toArrow()
    table = np.zeros((blocks, SIEVE_BLOCK // 8), dtype=np.uint8)
    for chunk in parts.to_batches():  # at most a row a block
        for b, bits in zip(chunk.column(0).to_pylist(), chunk.column(1), strict=True):
            table[b] = np.frombuffer(bits.as_buffer(), dtype=np.uint8)
    return table


def passed(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the pieces that a sieve may know; none that it does is missing."""
    block, marks = _marks(hashes, len(table))
    alive = np.arange(len(hashes))
    for at in marks:
        alive = alive[(table[block[alive], at[alive] >> 3] >> (at[alive] & 7).astype(np.uint8)) & 1 > 0]
    return alive


def snippets(texts: DataFrame, shared: DataFrame, n: int, span: int, gram: int) -> DataFrame:
    """(piece, doc_id, text_key, start, snippet): the runs whose piece is one of the ``n`` in ``shared``.

    With up to ``MAX_SHARED`` pieces tasks tell them by a sieve, which lets a few others pass: those
    are of one text, so nothing is taken from their snippets.
    """
    if n > MAX_SHARED:
        return joined_snippets(texts, shared, span, gram)
    spark = texts.sparkSession
    held = spark.sparkContext.broadcast(sieve(shared, n))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, end, data, offsets in pieces(batch.column(2)):
            low, stop, hashes = sampled(data, offsets, span, gram)
            keep = passed(held.value, hashes)
            low, stop, hashes = low[keep], stop[keep], hashes[keep]
            row = _of_rows(low, offsets)
            high = stop - 1 + span
            raw = data.tobytes()
            take = pa.array(row)
            yield {
                "piece": hashes.view(np.int64),
                "doc_id": batch.column(0).slice(first, end - first).take(take),
                "text_key": batch.column(1).slice(first, end - first).take(take),
                "start": low - offsets[row],
                "snippet": [raw[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)],
            }

    schema = "piece bigint, doc_id bigint, text_key bigint, start bigint, snippet binary"
    return map_batches(texts.select("doc_id", "text_key", "text"), schema, work)


def joined_snippets(texts: DataFrame, shared: DataFrame, span: int, gram: int) -> DataFrame:
    """``snippets`` for any number of pieces: places meet the pieces, then the texts they are cut from.

    Bytes move once, as texts; the runs of pieces that are not shared move without theirs.
    """

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, end, data, offsets in pieces(batch.column(2)):
            low, stop, hashes = sampled(data, offsets, span, gram)
            row = _of_rows(low, offsets)
            take = pa.array(row)
            yield {
                "piece": hashes.view(np.int64),
                "doc_id": batch.column(0).slice(first, end - first).take(take),
                "text_key": batch.column(1).slice(first, end - first).take(take),
                "start": low - offsets[row],
                "n": stop - 1 + span - low,
            }

    schema = "piece bigint, doc_id bigint, text_key bigint, start bigint, n bigint"
    runs = map_batches(texts.select("doc_id", "text_key", "text"), schema, work)
    runs = stage(runs.join(shared.select("piece"), "piece", "left_semi"), "suffix-runs")
    of_text = runs.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("piece", "start", "n")).alias("runs"))
    cut = texts.select("doc_id", "text_key", "text").join(of_text, ["doc_id", "text_key"])
    cut = cut.select("doc_id", "text_key", "text", F.explode("runs").alias("run"))
    snippet = F.substring("text", (F.col("run.start") + 1).cast("int"), F.col("run.n").cast("int"))
    return cut.select("run.piece", "doc_id", "text_key", "run.start", snippet.alias("snippet"))


def _contested(found: pa.Table) -> Iterator[pa.Table]:
    """Shards of the rows whose piece has snippets of several smallest ids, piece by piece.

    All strings with a sampled piece are in snippets of that piece, so one whose snippets
    have one smallest id has no string that an earlier document has too.
    """
    piece = np.asarray(found.column("piece"), dtype=np.int64)
    order = np.argsort(piece, kind="stable")
    ids, piece = np.asarray(found.column("doc_id"), dtype=np.int64)[order], piece[order]
    first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
    several = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
    rows = np.diff(np.append(first, len(piece)))
    order, rows = order[np.repeat(several, rows)], rows[several]
    if not len(order):
        return
    found = found.take(pa.array(order))
    sizes = np.asarray(pc.binary_length(found.column("snippet")), dtype=np.int64)
    ends = np.cumsum(rows)
    upto = np.cumsum(sizes)[ends - 1]  # bytes up to the end of each piece
    shards = -(-int(upto[-1]) // SHARD_BYTES)
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards) if shards > 1 else []
    at = 0
    for end in [*ends[np.asarray(cuts, dtype=np.int64)].tolist(), len(order)]:
        if end > at:
            yield found.slice(at, end - at)
        at = end


def earlier_parts(different: DataFrame, shards: int, span: int) -> DataFrame:
    """(piece, snippet_key, lows, highs): where smaller ids have a snippet's strings.

    ``different`` is (piece, snippet, snippet_key, doc_id), the smallest id of each
    snippet.  The ranges are of start positions in the snippet.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if len(batch)]
        if batches:
            for shard in _contested(pa.Table.from_batches(batches)):
                yield from sort(shard)

    def sort(shard: pa.Table) -> Iterator[pa.RecordBatch]:
        raw = shard.column("snippet").to_pylist()
        of_piece, keys, ids = (
            np.asarray(shard.column(name), dtype=np.int64) for name in (*KEYS, "doc_id")
        )
        sizes = np.array([len(s) for s in raw], dtype=np.int64) + 1
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"\0".join(raw) + b"\0", dtype=np.uint8)
        text = data.astype(np.int16) + 1
        text[ends - 1] = 0
        positions, prefixes = sorted_suffixes(text, span, prefix_sums(data), span_hashes)
        same = prefixes >= span
        # Runs of equal strings, and the smallest id in each.
        run = np.cumsum(~same)
        owner = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)[positions]
        least = np.full(int(run[-1]) + 1 if len(run) else 1, np.iinfo(np.int64).max)
        first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        least[run[first]] = np.minimum.reduceat(ids[owner], first)
        hit = np.sort(positions[least[run] < ids[owner]])
        cuts = np.flatnonzero(np.append(True, hit[1:] != hit[:-1] + 1))[: len(hit)]
        low = hit[cuts]
        high = np.append(hit[cuts[1:] - 1], hit[-1:]) + 1 if len(hit) else low
        of = np.searchsorted(ends, low, side="right")
        begin = ends[of] - sizes[of]
        own, start = np.unique(of, return_index=True)
        bounds = np.append(start, len(of))
        lows, highs = low - begin, high - begin
        offsets = pa.array(bounds.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(of_piece[own]), pa.array(keys[own]),
                pa.ListArray.from_arrays(offsets, pa.array(lows)), pa.ListArray.from_arrays(offsets, pa.array(highs)),
            ],
            names=[*KEYS, "lows", "highs"],
        )

    dealt = different.select("piece", "snippet", "snippet_key", "doc_id").repartition(shards, "piece")
    return dealt.mapInArrow(work, "piece bigint, snippet_key bigint, lows array<bigint>, highs array<bigint>")


def oversized(different: DataFrame) -> tuple[DataFrame | None, int]:
    """(the pieces whose snippets outgrow a shard or None, bytes of all snippets)."""
    rows = different.select(
        "piece", F.pmod("piece", F.lit(BUCKETS)).alias("bucket"), F.octet_length("snippet").cast("bigint").alias("n")
    )
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    n = np.asarray(sums.column("n").combine_chunks(), dtype=np.int64)
    full = np.asarray(sums.column("bucket").combine_chunks(), dtype=np.int64)[n > SHARD_BYTES]
    if not len(full):
        return None, int(n.sum())
    if len(full) <= 1000:
        rows = rows.filter(F.col("bucket").isin(full.tolist()))
    found = rows.groupBy("piece").agg(F.sum("n").alias("n")).filter(F.col("n") > SHARD_BYTES)
    return stage(found.select("piece"), "suffix-oversized"), int(n.sum())


def earlier_strings(different: DataFrame, span: int) -> DataFrame:
    """``earlier_parts`` string by string, for pieces that no task should hold whole."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece, key, doc, snippet in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            for low in range(0, len(snippet) - span + 1, STRINGS):
                at = range(low, min(low + STRINGS, len(snippet) - span + 1))
                yield {
                    "piece": [piece] * len(at), "snippet_key": [key] * len(at), "doc_id": [doc] * len(at), "at": list(at),
                    "string": [snippet[k : k + span] for k in at],
                }

    schema = "piece bigint, snippet_key bigint, doc_id bigint, at bigint, string binary"
    strings = stage(map_batches(different.select(*KEYS, "doc_id", "snippet"), schema, work), "suffix-strings")
    # Partial minima: a string in all snippets is one row per task.
    least = strings.groupBy("string").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = small_side(stage(least.filter("least < most").select("string", "least"), "suffix-least"))
    hits = strings.join(least, "string").filter("least < doc_id")
    return hits.groupBy(*KEYS).agg(F.collect_list("at").alias("lows")).select(
        *KEYS, "lows", F.transform("lows", lambda x: x + 1).alias("highs")
    )


def repeated_spans(texts: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """A table (doc_id, text_key, lows, highs): byte ranges of each text that go, not yet merged.

    ``texts`` is (doc_id, text_key, text), without null ids and with no two rows of equal
    text and id.  The tables on the way are deleted.
    """
    spark = texts.sparkSession
    with dropped_shuffles(spark), staging(spark):
        shared = stage(piece_counts(texts, span, gram).filter("n > 1").select("piece"), "suffix-pieces")
        n = shared.count()
        parts = min(PARTS, n // PART_PIECES + 1)
        rows = snippets(texts, shared, n, span, gram).select(
            "*", F.xxhash64("snippet").alias("snippet_key"), F.octet_length("snippet").alias("n")
        )
        marked = []
        # All with a piece is in one part, so parts know nothing of each other.
        for part, path in stage_parts(rows, "suffix-snippets", F.pmod("piece", F.lit(parts)).cast("int"), parts):
            with staging(spark):
                marked.append(stage_outside(marked_parts(part, span), "suffix-marked"))
            delete_path(spark, path)
        spans = reduce(DataFrame.union, marked).groupBy("doc_id", "text_key").agg(
            F.flatten(F.collect_list("lows")).alias("lows"), F.flatten(F.collect_list("highs")).alias("highs")
        )
        return stage_outside(spans, "suffix-spans")


def marked_parts(rows: DataFrame, span: int) -> DataFrame:
    """(doc_id, text_key, lows, highs): what goes of each snippet, as byte ranges of its text.

    ``rows`` is a table of ``snippets`` with their keys and sizes, with all or none of a piece.
    """
    different = rows.groupBy("piece", "snippet", "snippet_key").agg(F.min("doc_id").alias("doc_id"))
    different = stage(different, "suffix-different")
    large, size = oversized(different)
    shards = int(size / (SHARD_BYTES * DEALT_SHARDS)) + 1
    if large is None:
        earlier = earlier_parts(different, shards, span)
    else:
        large = small_side(large)
        earlier = earlier_parts(different.join(large, "piece", "left_anti"), shards, span).union(
            earlier_strings(different.join(large, "piece", "left_semi"), span)
        )
    earlier = stage(earlier, "suffix-earlier")
    owners = different.select(*KEYS, F.col("doc_id").alias("owner"))
    found = owners.join(earlier, KEYS, "left")
    slim = rows.select("doc_id", "text_key", "start", *KEYS, "n")
    # All of a snippet goes where it is not the first; of the first, what others have had.
    marked = slim.join(found, KEYS).filter("n >= %d and (doc_id > owner or lows is not null)" % span)
    later = F.col("doc_id") > F.col("owner")
    lows = F.when(later, F.array(F.col("start"))).otherwise(F.transform("lows", lambda x: x + F.col("start")))
    highs = F.when(later, F.array(F.col("start") + F.col("n"))).otherwise(
        F.transform("highs", lambda x: x + F.col("start") + (span - 1))
    )
    return marked.select("doc_id", "text_key", lows.alias("lows"), highs.alias("highs"))


def merge_spans(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ascending ranges with gaps between them that cover the same bytes."""
    order = np.argsort(lows, kind="stable")
    lows, reach = lows[order], np.maximum.accumulate(highs[order])
    new = np.append(True, lows[1:] > reach[:-1])
    return lows[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(lows) - 1)]


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, lows, highs, kept_sha256) of every row: the byte ranges removed.

    Texts are UTF-8 bytes, null is empty.  Rows without an id lose nothing and take
    nothing from others; rows that share an id take nothing from each other.  Texts of
    fewer than ``span`` bytes stay.  Extra columns are ignored; empty tables give empty results.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw.alias("text"))
    slim = slim.withColumn("text_key", F.xxhash64("text"))
    with dropped_shuffles(docs.sparkSession):
        nodes = stage(slim.select("doc_id", "text_key", F.md5("text").alias("whole")), "suffix-texts")
        firsts = nodes.filter("doc_id is not null").groupBy("whole").agg(F.min("doc_id").alias("first"))
        copies = nodes.join(firsts, "whole").filter("doc_id > first").select("doc_id", "text_key")
        copies = stage(copies.distinct(), "suffix-copies")
    copied = small_side(copies.withColumn("copied", F.lit(True)))
    keyed = slim.filter(F.octet_length("text") >= span)
    texts = keyed.filter("doc_id is not null").join(copied, ["doc_id", "text_key"], "left_anti")
    spans = repeated_spans(texts, span, gram)
    whose = small_side(spans.select("doc_id", "text_key"))
    none = F.array().cast("array<bigint>")
    gone = F.col("copied").isNotNull() & (F.octet_length("text") >= span)
    size = F.octet_length("text").cast("bigint")
    plain = slim.join(whose, ["doc_id", "text_key"], "left_anti").join(copied, ["doc_id", "text_key"], "left")
    plain = plain.select(
        "doc_id", size.alias("n_bytes"),
        F.when(gone, F.array(F.lit(0).cast("bigint"))).otherwise(none).alias("lows"),
        F.when(gone, F.array(size)).otherwise(none).alias("highs"),
        F.sha2(F.when(gone, F.lit(b"")).otherwise(F.col("text")), 256).alias("kept_sha256"),
    )
    touched = slim.join(whose, ["doc_id", "text_key"], "left_semi").join(spans, ["doc_id", "text_key"])

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {"n_bytes": [], "lows": [], "highs": [], "kept_sha256": []}
        for value, lows, highs in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
            body = value.as_py()
            low, high = merge_spans(np.asarray(lows.values), np.asarray(highs.values))
            kept, at = hashlib.sha256(), 0
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                kept.update(body[at:a])
                at = b
            kept.update(body[at:])
            for name, x in zip(out, (len(body), low.tolist(), high.tolist(), kept.hexdigest()), strict=True):
                out[name].append(x)
        yield {"doc_id": batch.column(0), **out}

    schema = "doc_id bigint, n_bytes bigint, lows array<bigint>, highs array<bigint>, kept_sha256 string"
    changed = map_batches(touched.select("doc_id", "text", "lows", "highs"), schema, cut)
    return plain.union(changed)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    removed = F.aggregate(
        F.zip_with("lows", "highs", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y
    )
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("lows").cast("bigint").alias("n_spans"), "kept_sha256"
    )
