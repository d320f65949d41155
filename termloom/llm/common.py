"""Helpers that several operators share: words and hashes of byte buffers, links, offsets.

The numpy helpers work inside tasks on slices of an Arrow batch; ``pieces`` keeps a
slice near ``PIECE_BYTES`` (one text is never cut), so the arrays of eight bytes per
text byte stay small whatever the batch size is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.session import stage

PIECE_BYTES = 1 << 20
MAX_BROADCAST_ROWS = 200_000

_U = np.uint64
_RNG = np.random.default_rng(20_240_607)
BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
BASE = _U(0x9E3779B97F4A7C15)
BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))


def lowered() -> np.ndarray:
    """A byte table that lower-cases A-Z and leaves every other byte alone."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lowered()
NOT_SPACE = ~np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
WORD_BYTE = np.arange(256) >= 0x80
WORD_BYTE[0x30:0x3A] = True
WORD_BYTE[0x61:0x7B] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of position-weighted bytes: hashes of all substrings in O(1) each."""
    powers = _power_table("up", BASE, len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * powers[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end)."""
    down = _power_table("down", BASE_INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def as_binary(column: pa.Array) -> pa.Array:
    """A string or binary column as binary with 64-bit offsets; null becomes empty."""
    return column.cast(pa.large_binary()).fill_null(b"")


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets within the bytes) of a text column."""
    column = as_binary(column)
    if not len(column):
        return
    _, raw, body = column.buffers()
    offsets = np.frombuffer(raw, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    first, n = 0, len(column)
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield (
            first,
            end,
            data[offsets[first] : offsets[end]],
            offsets[first : end + 1] - offsets[first],
        )
        first = end


@dataclass
class Words:
    """Words of a slice: byte spans, 64-bit hashes and the word range of each row."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """Maximal runs of member bytes after lower-casing A-Z; no run crosses a row."""
    data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = member[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    here = inside[1:-1]
    starts = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    hashes = span_hashes(prefix_sums(data), starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def map_batches(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], Iterator[dict]]
) -> DataFrame:
    """``mapInArrow`` of a function from a batch to dictionaries of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                        for f, c in ((f, columns[f.name]) for f in target)
                    ],
                    schema=target,
                )
        give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Return freed memory to the system: Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        return


def small_side(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a staged table of a few fixed-width columns when it has few rows.

    Beyond the limit the join is planned as any other; the rows are the same.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(id, component): the smallest id that the links ``a``, ``b`` reach.

    Every round takes the least label among the neighbours (partial minima, so a hub
    costs one row per task) and then follows labels of labels, which halves paths.
    Rounds are tables in the shared folder.
    """
    both = stage(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), label
    )
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("id"), F.min("b")).alias("component")), label)
    while True:
        at_b = labels.select(F.col("id").alias("b"), F.col("component").alias("theirs"))
        near = both.join(at_b, "b").groupBy(F.col("a").alias("id")).agg(F.min("theirs").alias("m"))
        step = labels.join(near, "id").select(
            "id", "component", F.least("component", "m").alias("low")
        )
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("beyond"))
        after = stage(
            step.join(jump, "low").select(
                "id", F.least("low", "beyond").alias("component"),
                (F.least("low", "beyond") != F.col("component")).alias("moved"),
            ),
            label,
        )
        labels = after.select("id", "component")
        if not after.filter("moved").limit(1).count():
            return labels


def range_bounds(df: DataFrame, key: str, parts: int) -> list:
    """At most ``parts - 1`` ascending values that split ``key`` into even ranges."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, at, 10_000).alias("q")).first()["q"] or []
    return sorted(set(found))


def range_of(key: str, bounds: list):
    """The number of the range that holds a value: 0 for null and the lowest."""
    if not bounds:
        return F.lit(0)
    if len(bounds) <= 64:
        where = F.lit(0)
        for i, bound in enumerate(bounds):
            where = F.when(F.col(key) > F.lit(bound), F.lit(i + 1)).otherwise(where)
        return where
    table = F.array(*[F.lit(b) for b in bounds])
    return F.coalesce(F.size(F.filter(table, lambda b: b < F.col(key))), F.lit(0))


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
