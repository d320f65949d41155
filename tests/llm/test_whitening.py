"""Whitening: the polar iteration, the split components, brute force and edges."""

from __future__ import annotations

import math

import numpy as np
import pytest

from termloom.llm import spectral, whitening
from termloom.llm import queries as registry

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, x string, component string"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, 2, "x", "c") for i, v in rows], schema)


def brute(rows, top=32):
    """{vec_id: deviation}, {component: explained}, covariance, for finite vectors of one length."""
    ids = [i for i, _ in rows]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = {i: int(((n * r - sums) ** 2).sum()) for i, r in zip(ids, x)}
    centred = np.array((n * x - sums) / n, dtype=float)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return deviation, values[::-1][:top], vectors[:, ::-1][:, :top], centred, np.trace(covariance)


def random_symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, dtype=float)) @ q.T


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 150])
def test_polar_factor_is_the_matrix_sign(n):
    values = np.linspace(-3, 5, n) + 0.01
    a = random_symmetric(values, n)
    u = spectral.polar(a)
    assert np.allclose(u, random_symmetric(np.sign(values), n), atol=1e-12)
    assert np.allclose(u @ u, np.eye(n), atol=1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [1.0], [0.0, 0.0], [2.0, 2.0, 2.0], [5, 5, 1, 1, 0, 0], [1e6, 1, 1e-6], list(range(40)),
        [1 + 1e-9, 1, 1 - 1e-9], [10.0] + [1.0] * 30, list(np.geomspace(1e4, 1e-4, 80)),
    ],
)
def test_components_are_eigenvectors(values):
    a = random_symmetric(values, 3)
    found, vectors = spectral.components(a)
    scale = max(np.linalg.norm(a), 1e-300)
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-13 * len(values) * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13 * len(values))
    assert np.linalg.norm(a @ vectors - vectors * found) <= 1e-13 * len(values) * scale


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for size in (100, 1 << 20, 1 << 41):
        y = rng.integers(-size, size, (5000, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.products(y).tolist() == want


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    deviation, values, vectors, centred, trace = brute(rows)
    found = registry.queries()["op11_qdwh_whitening"](spark, sf_dir).collect()
    assert len(found) == 32 * len(rows)
    want = centred @ vectors / np.sqrt(values)
    place = {i: k for k, (i, _) in enumerate(rows)}
    got = np.zeros_like(want)
    for r in found:
        c = r["component"] - 1
        assert r["n"] == len(rows) and r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[c] / trace, rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-6
        got[place[r["vec_id"]], c] = r["whitened"]
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * signs, want, atol=1e-8)
    assert np.abs(got.T @ got / len(rows) - np.eye(32)).max() < 1e-10
    assert len({r["identity_error"] for r in found}) == 1


def test_more_dimensions_than_a_row_of_sums_holds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.standard_normal(130)]) for i in range(200)]
    deviation, values, *_, trace = brute(rows)
    found = whitening.whiten(table(spark, rows, SCHEMA.replace("array<float>", "array<double>"))).collect()
    assert {r["vec_id"]: r["deviation"] for r in found} == deviation
    shares = {r["component"]: r["explained"] for r in found}
    assert [shares[c + 1] for c in range(32)] == pytest.approx(list(values / trace))
    assert found[0]["identity_error"] < 1e-6


def test_dropped_vectors_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, -1.0]), (4, [3.5, 0.25]), (5, [-2.0, 9.0])]
    bad = [(10, None), (11, [1.0, None]), (12, [nan, 1.0]), (13, [1.0, -inf])]
    found = whitening.whiten(table(spark, good + bad)).collect()
    deviation, values, _, _, trace = brute([(i if i else 0, v) for i, v in good])
    assert len(found) == 10
    for r in found:
        assert r["deviation"] == deviation[r["vec_id"] or 0] and r["n"] == 5
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace)
    white = np.array([[r["whitened"] for r in found if r["component"] == c] for c in (1, 2)])
    assert np.allclose(white @ white.T / 5, np.eye(2))


def test_empty_tables_and_vectors(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [None])])).count() == 0
    assert whitening.whiten(table(spark, [(1, []), (2, [])])).count() == 0


def test_components_without_variance(spark):
    found = whitening.whiten(table(spark, [(1, [1.0, 5.0, 2.0]), (2, [3.0, 5.0, 2.0])])).collect()
    first = sorted(r["whitened"] for r in found if r["component"] == 1)
    assert first == pytest.approx([-1.0, 1.0])
    rest = [r for r in found if r["component"] > 1]
    assert len(rest) == 4 and all(r["whitened"] is None and r["explained"] == 0 for r in rest)
    assert all(r["identity_error"] < 1e-9 for r in found)
    alone = whitening.whiten(table(spark, [(1, [1.0, 5.0])])).collect()
    assert [(r["deviation"], r["whitened"], r["identity_error"]) for r in alone] == [(0, None, None)] * 2


def test_lengths_differ_and_entries_are_huge(spark):
    mixed = [(1, [1.0, 2.0]), (2, [3.0]), (3, []), (4, [5.0, 7.0])]
    filled = [(i, (v + [0.0, 0.0])[:2]) for i, v in mixed]
    deviation, values, *_ , trace = brute(filled)
    found = whitening.whiten(table(spark, mixed)).collect()
    assert {r["vec_id"]: r["deviation"] for r in found} == deviation
    assert found[0]["explained"] == pytest.approx(values[0] / trace)
    schema = SCHEMA.replace("array<float>", "array<double>")
    huge = whitening.whiten(table(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])], schema)).collect()
    assert all(r["whitened"] is None or abs(r["whitened"]) < 2 for r in huge)
    assert {r["vec_id"]: r["deviation"] for r in huge}[1] is None
