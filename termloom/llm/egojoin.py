"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of at least ``least`` lie within ``epsilon = sqrt(2 - 2 least)``
of each other, in every projection too.  Vectors are projected on their leading principal
directions and sorted by the cells of a grid of side ``epsilon`` there, first direction
first.  The order is cut into intervals of bounded length; two intervals join only if no
direction keeps them apart, and inside a task the two sequences are halved recursively,
dropping halves that are provably too far, down to blocks compared by a matrix product.

Vectors of one label with equal components become one class before anything is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import connected_components, map_batches, parallelism
from termloom.session import stage

DIRECTIONS = 6
#: Rows of the sample that the principal directions are fitted on; any directions are exact.
FIT_ROWS = 4096
INTERVAL = 512
LEAF = 64


def _components(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Vectors of a list column in double precision; None where nothing can be linked."""
    for value in column:
        v = value.as_py()
        if not v or any(x is None for x in v):
            yield None
            continue
        v = np.array(v, dtype=np.float64)
        norm = np.sqrt(v @ v)
        yield v if np.isfinite(v).all() and np.isfinite(norm) and norm > 0 else None


def usable_vectors(rows: DataFrame) -> DataFrame:
    """(id, label, size, vector) of the vectors that can be linked, vectors as bytes."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        found = list(_components(batch.column(2)))
        yield {
            "id": batch.column(0),
            "label": batch.column(1),
            "size": [0 if v is None else len(v) for v in found],
            "vector": [None if v is None else (v + 0.0).tobytes() for v in found],
        }

    kept = map_batches(rows, "id bigint, label string, size int, vector binary", work)
    return kept.filter("vector is not null and label is not null and id is not null")


def principal_directions(classes: DataFrame, size: int) -> np.ndarray:
    """Leading eigenvectors of the second moments of a bounded sample of unit vectors."""
    sample = classes.filter(F.col("size") == size).orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)
    rows = [np.frombuffer(r["vector"]) for r in sample.select("vector").collect()]
    x = np.stack(rows)
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    x = x - x.mean(axis=0)
    _, vectors = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(vectors[:, ::-1][:, :DIRECTIONS])


def grid_order(classes: DataFrame, directions: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """Each class with its grid cells, which sort it, and its place along each direction."""
    shared = classes.sparkSession.sparkContext.broadcast(directions)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        places = np.zeros((len(batch), DIRECTIONS))
        for i, raw in enumerate(batch.column(3)):
            v = np.frombuffer(raw.as_py())
            p = v @ shared.value[len(v)] / np.sqrt(v @ v)
            places[i, : len(p)] = p
        cells = np.floor(places / epsilon).astype(np.int64)
        yield {
            **{n: batch.column(i) for i, n in enumerate(("id", "label", "size", "vector", "n"))},
            **{f"c{k}": cells[:, k] for k in range(DIRECTIONS)},
            "places": [p.tolist() for p in places],
        }

    cells = ", ".join(f"c{k} bigint" for k in range(DIRECTIONS))
    schema = f"id bigint, label string, size int, vector binary, n bigint, {cells}, places array<double>"
    return map_batches(classes.select("id", "label", "size", "vector", "n"), schema, work)


def intervals(ordered: DataFrame) -> DataFrame:
    """Runs of at most ``INTERVAL`` classes in grid order, with their extent.

    The order is total over range partitions; an interval ends with its partition, label,
    vector length or first cell, so it lies in one cell of the leading direction.
    """
    keys = ["label", "size", *(f"c{k}" for k in range(DIRECTIONS)), "id"]
    tasks = parallelism(ordered.sparkSession)
    spread = ordered.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    names = ("label", "size", "c0", "id", "n", "places", "vector")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            places = np.array([r[5] for r in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([held[0][0]], pa.string()), pa.array([held[0][1]], pa.int32()),
                    pa.array([held[0][2]], pa.int64()), pa.array([held[0][3]], pa.int64()),
                    pa.array([[r[3] for r in held]], pa.list_(pa.int64())),
                    pa.array([[r[4] for r in held]], pa.list_(pa.int64())),
                    pa.array([places.min(axis=0).tolist()], pa.list_(pa.float64())),
                    pa.array([places.max(axis=0).tolist()], pa.list_(pa.float64())),
                    pa.array([places.tobytes()], pa.binary()),
                    pa.array([b"".join(r[6] for r in held)], pa.binary()),
                ],
                names=["label", "size", "c0", "key", "ids", "ns", "low", "high", "places", "vectors"],
            )

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(len(names))), strict=True):
                if held and (len(held) >= INTERVAL or row[:3] != held[0][:3]):
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    return spread.select(*names).mapInArrow(
        pack,
        "label string, size int, c0 bigint, key bigint, ids array<bigint>, ns array<bigint>,"
        " low array<double>, high array<double>, places binary, vectors binary",
    )


def near_intervals(boxes: DataFrame, epsilon: float) -> DataFrame:
    """Pairs (a, b) of intervals that no direction keeps apart, a at most b.

    They share label and length and lie in the same or in neighbouring leading cells, so
    the pairs come from equality joins on the cell.
    """
    slim = boxes.select("label", "size", "c0", "key", "low", "high")
    one = slim.select("label", "size", F.explode(F.array(F.col("c0"), F.col("c0") + 1)).alias("c0"),
                      F.col("c0").alias("home"), F.col("key").alias("a"), F.col("low").alias("la"),
                      F.col("high").alias("ha"))
    two = slim.select("label", "size", "c0", F.col("key").alias("b"), F.col("low").alias("lb"),
                      F.col("high").alias("hb"))
    joined = one.join(two, ["label", "size", "c0"]).filter((F.col("home") < F.col("c0")) | (F.col("a") <= F.col("b")))
    near = F.lit(True)
    for k in range(DIRECTIONS):
        apart = F.greatest(F.get("la", k) - F.get("hb", k), F.get("lb", k) - F.get("ha", k))
        near = near & (apart <= epsilon * (1 + 1e-9))
    return joined.filter(near).select("a", "b")


def join_sequences(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], epsilon: float, least: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i of a, j of b) with a cosine of at least ``least``.

    Each side is (places along the directions, unit vectors) in grid order.  The longer
    one is halved until both are leaves; parts that a direction keeps apart are dropped.
    """
    work = [((0, len(a[0])), (0, len(b[0])))]
    slack = epsilon * (1 + 1e-9)
    while work:
        (i, m), (j, n) = work.pop()
        p, q = a[0][i:m], b[0][j:n]
        apart = np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0))
        if (apart > slack).any():
            continue
        if m - i <= LEAF and n - j <= LEAF:
            x, y = np.nonzero(a[1][i:m] @ b[1][j:n].T >= least)
            if len(x):
                yield x + i, y + j
        elif m - i >= n - j:
            half = (i + m) // 2
            work += [((i, half), (j, n)), ((half, m), (j, n))]
        else:
            half = (j + n) // 2
            work += [((i, m), (j, half)), ((i, m), (half, n))]


def _forest(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all links (x, y) connect, at most one less than the ends."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        r, s = root(i), root(j)
        if r != s:
            parent[max(r, s)] = min(r, s)
            kept.append((i, j))
    return kept


def link_intervals(pairs: DataFrame, boxes: DataFrame, epsilon: float, least: float) -> DataFrame:
    """Rows (a, b, n): a class ``a`` has ``n`` more linked vectors, or links to class ``b``.

    A pair of intervals gives one count for each linked class and the links of a spanning
    forest, never all its pairs.
    """
    side = boxes.select("key", "size", "ids", "ns", "places", "vectors")
    one = side.toDF("a", "size", "ids_a", "ns_a", "places_a", "vectors_a")
    two = side.drop("size").toDF("b", "ids_b", "ns_b", "places_b", "vectors_b")
    joined = pairs.join(one, "a").join(two, "b").select(
        "a", "b", "size", "ids_a", "ns_a", "places_a", "vectors_a", "ids_b", "ns_b", "places_b", "vectors_b"
    )

    def unit(places: bytes, vectors: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(vectors).reshape(-1, size)
        return np.frombuffer(places).reshape(-1, DIRECTIONS), x / np.sqrt((x * x).sum(axis=1))[:, None]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in zip(*(batch.column(k) for k in range(11)), strict=True):
            a, b, size, ids_a, ns_a, places_a, vectors_a, ids_b, ns_b, places_b, vectors_b = (
                v.as_py() for v in row
            )
            ids_a, ids_b = np.array(ids_a), np.array(ids_b)
            ns_a, ns_b = np.array(ns_a), np.array(ns_b)
            left, right = unit(places_a, vectors_a, size), unit(places_b, vectors_b, size)
            found = list(join_sequences(left, right, epsilon, least))
            if not found:
                continue
            x = np.concatenate([f[0] for f in found])
            y = np.concatenate([f[1] for f in found])
            if a == b:
                x, y = x[x < y], y[x < y]
            more_a = np.bincount(x, weights=ns_b[y], minlength=len(ids_a)).astype(np.int64)
            more_b = np.bincount(y, weights=ns_a[x], minlength=len(ids_b)).astype(np.int64)
            links = _forest(ids_a[x], ids_b[y])
            at_a, at_b = np.flatnonzero(more_a), np.flatnonzero(more_b)
            yield {
                "a": np.concatenate([ids_a[at_a], ids_b[at_b], np.array([p for p, _ in links], dtype=np.int64)]),
                "b": [None] * (len(at_a) + len(at_b)) + [q for _, q in links],
                "n": np.concatenate([more_a[at_a], more_b[at_b], np.zeros(len(links), dtype=np.int64)]),
            }

    return map_batches(joined, "a bigint, b bigint, n bigint", work)


def near_vectors(rows: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Two rows link when their labels are equal and not null and the cosine of their
    vectors, in double precision, is at least ``least``; vectors of different lengths do
    not link.  Null, empty and zero vectors, and those with null or non-finite
    components, link with nothing; nor do rows without an id, whose component is null.
    Rows that repeat an id count as vectors of their own.  Extra columns are ignored.
    """
    epsilon = float(np.sqrt(2 - 2 * least))
    slim = rows.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    usable = stage(usable_vectors(slim), "ego-vectors")
    classes = stage(
        usable.groupBy("label", "size", "vector").agg(F.min("id").alias("id"), F.count("*").alias("n")),
        "ego-classes",
    )
    sizes = [r["size"] for r in classes.select("size").distinct().collect()]
    directions = {size: principal_directions(classes, size) for size in sizes}
    boxes = stage(intervals(grid_order(classes, directions, epsilon)), "ego-intervals")
    pairs = stage(near_intervals(boxes, epsilon), "ego-pairs")
    found = stage(link_intervals(pairs, boxes, epsilon, least), "ego-links")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    labels = connected_components(
        found.filter("b is not null").select("a", "b"), "ego-components"
    ).withColumnRenamed("id", "a")
    reps = classes.withColumnRenamed("id", "a").join(counts, "a", "left").join(labels, "a", "left")
    reps = reps.select(
        "label", "size", "vector",
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "a").alias("component_id"),
    )
    linked = usable.join(reps, ["label", "size", "vector"]).groupBy("id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    out = slim.select("id").join(linked, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
