"""Whitening of embeddings: exact moments in Spark, QDWH components, broadcast projection.

Entries become integers, so sums and sums of products are exact whatever the order of
tasks and batches: tasks add up their slices in numpy, Spark adds the partial sums as
decimals.  Products are taken of integers centred at the rounded mean, and what rounding
left is taken out exactly, so the covariance is rounded once, when it becomes doubles.

The driver holds the moments (the square of the number of dimensions, whatever the number
of vectors) and splits the covariance by ``spectral.components``.  What is broadcast is the
mean and at most ``TOP`` components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import map_batches
from termloom.llm.spectral import EPS, components

TOP = 32
SCALE, SHIFT = 64, 1_000_000
#: Entries whose 64-fold is further from zero count as this far.
FURTHEST = 1 << 40
#: Values of a slice of a batch: 8 MB as doubles.
SLICE = 1 << 20
#: Below this, a product of two is exact as a double even when 2 ** 11 of them are added.
LIMB = 1 << 21

WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double,"
    " explained double, identity_error double"
)
#: Sums that travel in one row.
WIDTH = 64
MOMENTS = "n bigint, i int, part int, sums array<decimal(38,0)>"


def usable(entries: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return F.coalesce(entries.isNotNull() & finite, F.lit(False))


def vectors_of(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the usable vectors as doubles."""
    entries = F.col(column).cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), entries.alias("x"))
    return rows.filter(usable(F.col("x")))


def whole(batch: pa.RecordBatch, side: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Slices of a batch: ids and floor(64 c), one row per vector, short ones filled with 0."""
    step = max(1, SLICE // max(side, 1))
    for first in range(0, batch.num_rows, step):
        part = batch.slice(first, step)
        column = part["x"]
        lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
        x = np.zeros((part.num_rows, side))
        x[np.arange(side) < lengths[:, None]] = flat
        with np.errstate(over="ignore"):
            x = np.floor(np.clip(SCALE * x, -FURTHEST, FURTHEST))
        yield part["vec_id"], x.astype(np.int64)


def products(y: np.ndarray) -> np.ndarray:
    """The exact sum over rows of y y', as Python integers; entries are within 2 ** 42."""
    high, low = y >> 21, y & (LIMB - 1)
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for first in range(0, len(y), 1 << 11):
        a = high[first : first + (1 << 11)].astype(float)
        b = low[first : first + (1 << 11)].astype(float)
        total += (b.T @ b).astype(np.int64)
        if a.any():
            cross = (a.T @ b).astype(np.int64).astype(object)
            total += (cross + cross.T) << 21
            total += (a.T @ a).astype(np.int64).astype(object) << 42
    return total


def moments(
    vectors: DataFrame, side: int, integers: Callable[[np.ndarray], np.ndarray], squared: bool
) -> tuple[int, list[int], np.ndarray | None]:
    """(rows, sums, sums of products) of ``integers(x)`` over all vectors, exactly.

    A task sends its sums as row -1 and each row of its products, in parts of ``WIDTH``;
    the driver receives the totals, the square of ``side``.
    """
    from decimal import Decimal

    starts = range(0, side, WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, both = 0, None, None
        for batch in batches:
            for _, x in whole(batch, side):
                y = integers(x)
                n += len(y)
                # Below 2 ** 42 in size and at most 2 ** 20 rows: no sum leaves 64 bits.
                part = y.sum(axis=0).astype(object)
                sums = part if sums is None else sums + part
                if squared:
                    part = products(y)
                    both = part if both is None else both + part
        if n:
            rows = [sums, *(both if squared else ())]
            cut = [[Decimal(int(v)) for v in r[k : k + WIDTH]] for r in rows for k in starts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n] * len(cut), pa.int64()),
                    pa.array(np.repeat(np.arange(len(rows)) - 1, len(starts)), pa.int32()),
                    pa.array(np.tile(np.arange(len(starts)), len(rows)), pa.int32()),
                    pa.array(cut, pa.list_(pa.decimal128(38, 0))),
                ],
                ["n", "i", "part", "sums"],
            )

    parts = vectors.mapInArrow(run, MOMENTS)
    added = [
        F.sum(F.get("sums", F.lit(k))).cast("decimal(38,0)").alias(f"s{k}") for k in range(WIDTH)
    ]
    totals = np.zeros((side + 1, len(starts) * WIDTH), dtype=object)
    n = 0
    for r in parts.groupBy("i", "part").agg(F.sum("n").alias("n"), *added).collect():
        n = r["n"]
        for k in range(min(WIDTH, side - r["part"] * WIDTH)):
            totals[r["i"] + 1, r["part"] * WIDTH + k] = int(r[f"s{k}"])
    return n, list(totals[0, :side]), totals[1:, :side] if squared else None


def exact_covariance(n: int, sums: list[int], both: np.ndarray, unit: int = 1) -> np.ndarray:
    """(n * both - sums sums') / (n * unit) ** 2, rounded once."""
    side, below = len(sums), (n * unit) ** 2
    out = np.empty((side, side))
    for i in range(side):
        for j in range(i + 1):
            out[i, j] = out[j, i] = float(Fraction(n * both[i, j] - sums[i] * sums[j], below))
    return out


def whiten(embeddings: DataFrame, column: str = "embedding", top: int = TOP) -> DataFrame:
    """One row per usable vector and component up to ``top``, by falling eigenvalue.

    Vectors that are null or hold a null or a non-finite entry are dropped.  Where lengths
    differ, the longest is the number of dimensions and an entry that a vector lacks is 0;
    empty vectors alone, or no vector at all, give no rows.  An entry beyond 2 ** 34 counts
    as 2 ** 34.  A component without variance (as many as the vectors do not span) can't be
    brought to variance one: ``whitened`` is null, ``explained`` 0, and it does not count in
    ``identity_error``, which is null without any other.  A ``deviation`` that a long does
    not hold is null.  Equal vectors, repeated ids and null ids are rows as any other;
    columns besides ``vec_id`` and the vector are not read.
    """
    spark = embeddings.sparkSession
    vectors = vectors_of(embeddings, column)
    side = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    if not side:
        return spark.createDataFrame([], WHITENED)
    n, sums, _ = moments(vectors, side, lambda x: x, False)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    n, rest, both = moments(vectors, side, lambda x: x - centre, True)
    covariance = exact_covariance(n, rest, both)

    values, found = components(covariance)
    values, found = values[:top], found[:, :top]
    trace = float(np.trace(covariance))
    spanned = values > 8 * side * EPS * trace
    project = np.where(spanned, found / np.sqrt(np.where(spanned, values, 1.0)), 0.0)
    remainder = np.array([float(Fraction(r, n)) for r in rest])
    sent = spark.sparkContext.broadcast((centre, remainder, project))

    def project_rows(x: np.ndarray) -> np.ndarray:
        centre, remainder, project = sent.value
        return ((x - centre) - remainder) @ project

    error = None
    if spanned.any():
        # Of n numbers with mean square one none is above sqrt(n).
        unit = 1 << (40 - (int(n).bit_length() + 1) // 2)
        counted = moments_of_projection(vectors, side, project_rows, unit, len(values))
        held = np.flatnonzero(spanned)
        gap = exact_covariance(*counted, unit)[np.ix_(held, held)] - np.eye(len(held))
        error = float(np.abs(gap).max())
    shares = np.where(spanned, values / trace, 0.0) if trace else np.zeros(len(values))
    exact_rest = [int(r) for r in rest]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for ids, x in whole(batch, side):
            k = len(values)
            out = project_rows(x).ravel()
            far = deviations(x - sent.value[0], exact_rest, n)
            yield {
                "vec_id": ids.take(pa.array(np.repeat(np.arange(len(x)), k))),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "n": np.full(len(out), n),
                "deviation": pa.array([d for d in far for _ in range(k)], pa.int64()),
                "whitened": pa.array(out, mask=np.tile(~spanned, len(x))),
                "explained": np.tile(shares, len(x)),
                "identity_error": pa.array([error] * len(out), pa.float64()),
            }

    return map_batches(vectors, WHITENED, work)


def moments_of_projection(
    vectors: DataFrame, side: int, project_rows: Callable, unit: int, k: int
) -> tuple[int, list[int], np.ndarray]:
    """Moments of the whitened vectors, in whole units, so that they are exact sums too."""

    def integers(x: np.ndarray) -> np.ndarray:
        # Padded to the width that ``moments`` adds up.
        out = np.zeros((len(x), side), dtype=np.int64)
        out[:, :k] = np.rint(project_rows(x) * unit)
        return out

    n, sums, both = moments(vectors, side, integers, True)
    return n, sums[:k], both[:k, :k]


def deviations(y: np.ndarray, rest: list[int], n: int) -> list[int | None]:
    """Sum over dimensions of (n y - rest) ** 2, exactly; None beyond a long."""
    largest = n * int(np.abs(y).max(initial=0)) + max((abs(r) for r in rest), default=0)
    if largest * largest * max(len(rest), 1) < 1 << 63:
        gap = n * y - np.array(rest, dtype=np.int64)
        return np.einsum("ij,ij->i", gap, gap).tolist()
    found = []
    for row in y.tolist():
        total = sum((n * v - r) ** 2 for v, r in zip(row, rest, strict=True))
        found.append(total if total < 1 << 63 else None)
    return found
