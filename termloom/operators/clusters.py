"""One-dimensional k-means over similarity values."""

from __future__ import annotations

import logging
from collections.abc import Callable
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.index import Index
from termloom.operators.similarity import similar_terms
from termloom.session import stage

log = logging.getLogger(__name__)

# Fixed value: the number of steps after which clustering is given up.
MAX_STEPS = 100_000

# A similarity is at most 1; sums of its first 18 places are exact in any order.
EXACT = "decimal(20,18)"

# Distinct values up to which a step is not worth a job: some hundred bytes each.
SHORT = 10_000

Sums = dict[int, tuple[int, Decimal]]


def kmeans_init(points: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(cluster, centroid): k distinct similarity values, drawn by seeded hash.

    The same values and seed always give the same draw, on any cluster.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1; got {k}")
    digits = F.round(F.col("similarity") * 10**9).cast("bigint").cast("string")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), digits))
    drawn = (
        points.filter(~F.isnan("similarity"))
        .select("similarity")
        .distinct()
        .orderBy(draw, "similarity")
        .limit(k)
        .agg(F.collect_list(F.struct(draw.alias("draw"), "similarity")).alias("drawn"))
    )
    return drawn.select(F.posexplode(F.sort_array("drawn")).alias("cluster", "value")).select(
        "cluster", F.col("value.similarity").alias("centroid")
    )


def nearest(value: Column, centroids: Column) -> Column:
    """Index of the nearest centroid; the lowest index wins a tie."""
    distances = F.transform(centroids, lambda c: F.abs(value - c))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def kmeans_assign(points: DataFrame, centroids: list[float]) -> DataFrame:
    """Add ``cluster`` and ``centroid`` to every point."""
    values = F.lit([float(c) for c in centroids])
    assigned = points.withColumn("cluster", nearest(F.col("similarity"), values))
    return assigned.withColumn("centroid", F.get(values, F.col("cluster")))


def counted_values() -> list[Column]:
    """Number of points and their exact sum."""
    total = F.col("similarity").cast(EXACT) * F.col("n").cast("decimal(18,0)")
    return [F.sum("n").alias("n"), F.sum(total).alias("total")]


def cluster_sums(values: DataFrame) -> Callable[[list[float]], Sums]:
    """What gives, for centroids, the (points, exact sum) of each cluster that has any.

    A list of at most ``SHORT`` values is fetched once: a job for each step would take all its
    time to start.  A longer one is added up in a job per step.
    """
    head = values.limit(SHORT + 1).groupBy("similarity").agg(*counted_values()).collect()
    if len(head) > SHORT:

        def by_job(centroids: list[float]) -> Sums:
            rows = kmeans_assign(values, centroids).groupBy("cluster").agg(*counted_values())
            return {r["cluster"]: (r["n"], r["total"]) for r in rows.collect()}

        return by_job

    similarity = np.array([r["similarity"] for r in head], float)

    def on_driver(centroids: list[float]) -> Sums:
        # The first of the nearest, as in ``nearest``.
        cluster = np.abs(similarity[:, None] - np.array(centroids)).argmin(axis=1)
        found: Sums = {}
        for i, row in zip(cluster.tolist(), head):
            n, total = found.get(i, (0, Decimal(0)))
            found[i] = n + row["n"], total + row["total"]
        return found

    return on_driver


def kmeans_fit(
    points: DataFrame, k: int, seed: int = 0, max_iter: int = MAX_STEPS
) -> list[float]:
    """Centroids of Lloyd's algorithm, means at convergence.

    Every step is one aggregation over the distinct values, which are written
    once; the driver holds k sums and counts, and the values of a short list.  Sums are exact decimals, so a
    result does not depend on the order of tasks.  On a line each cluster is a
    run of the ordered values, so the assignment is stable as soon as the
    cluster sizes are.  A cluster that has lost its members keeps its centroid.
    No convergence within ``max_iter`` steps is an error.
    """
    counted = (
        points.filter(~F.isnan("similarity")).groupBy("similarity").agg(F.count("*").alias("n"))
    )
    values = stage(counted, "similarity-values")
    centroids = [r["centroid"] for r in kmeans_init(values, k, seed).orderBy("cluster").collect()]
    if len(centroids) < k:
        raise ValueError(f"{k} clusters need {k} distinct values; there are {len(centroids)}")
    sums = cluster_sums(values)
    sizes: list[int] = []
    for _ in range(max_iter):
        found = sums(centroids)
        new_sizes = [found[i][0] if i in found else 0 for i in range(k)]
        if new_sizes == sizes:
            return centroids
        sizes = new_sizes
        centroids = [
            float(found[i][1] / found[i][0]) if i in found else c
            for i, c in enumerate(centroids)
        ]
    raise RuntimeError(f"k-means did not converge within {max_iter} steps")


def kmeans_1d(points: DataFrame, k: int, seed: int = 0, max_iter: int = MAX_STEPS) -> DataFrame:
    """(cluster, centroid, term, similarity) of every point that is not NaN."""
    centroids = kmeans_fit(points, k, seed, max_iter)
    assigned = kmeans_assign(points.filter(~F.isnan("similarity")), centroids)
    return assigned.select("cluster", "centroid", "term", "similarity")


def terms_clusters(
    index: Index,
    field: str,
    term: str,
    top: int,
    rep: str,
    k: int,
    seed: int = 0,
    max_iter: int = MAX_STEPS,
) -> DataFrame:
    """The ``top`` terms most similar to ``term``, in k clusters by similarity.

    The ranked list is written once, so no step of the loop ranks it again.
    """
    points = stage(similar_terms(index, field, term, top, rep), "similar-terms")
    n_nan = points.filter(F.isnan("similarity")).count()
    if n_nan:
        log.warning("%d terms without a defined similarity are not clustered", n_nan)
    return kmeans_1d(points, k, seed, max_iter)


def cluster_summary(clusters: DataFrame, centroids: list[float]) -> DataFrame:
    """(cluster, centroid, elements) of every cluster, those without members too.

    ``centroids`` are those that ``clusters`` was assigned by; there are k of them.
    """
    numbered = [(i, float(c)) for i, c in enumerate(centroids)]
    every = clusters.sparkSession.createDataFrame(numbered, "cluster int, centroid double")
    counts = clusters.groupBy("cluster").agg(F.count("*").alias("elements"))
    return every.join(counts, "cluster", "left").withColumn(
        "elements", F.coalesce("elements", F.lit(0).cast("bigint"))
    )
