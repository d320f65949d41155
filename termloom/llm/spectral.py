"""Eigenvectors of a symmetric matrix by spectral divide and conquer on polar factors.

``polar`` is the dynamically weighted Halley iteration (QDWH): the orthogonal polar
factor of ``A - shift`` is its matrix sign, so ``(sign + 1) / 2`` projects onto the
eigenvectors above the shift.  ``components`` splits the space in two by such a projector
and goes on in both halves until a subspace is one vector or the matrix is a multiple of
the identity there.  Matrices here are covariances: their side is the number of
dimensions of a vector, not of vectors.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by QDWH."""
    n = len(a)
    eye = np.eye(n)
    x = a / np.linalg.norm(a)
    low = EPS  # below the smallest singular value, unless that one has no sign anyway
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        weight = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            after = (b / c) * x + (weight - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            half = np.linalg.solve(eye + c * (x.T @ x), x.T).T
            after = (b / c) * x + (weight - b / c) * half
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x = after
        low = min(low * (weight + b * square) / (1 + c * square), 1.0)
        if abs(low - 1) <= 10 * EPS and moved <= np.cbrt(EPS):
            break
        low = min(low, 1 - EPS)
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the eigenvectors above and below a shift between the extreme eigenvalues.

    A shift too near an eigenvalue leaves that vector without a sign and the two bases
    coupled; the next shift is tried then, and the least coupled split is kept.
    """
    n = len(a)
    diagonal = np.diag(a)
    mean = diagonal.mean()
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    best = None
    for shift in (np.median(diagonal), mean, *(mean + spread * f for f in (0.2, -0.2, 0.5, -0.5))):
        sign = polar(a - shift * np.eye(n))
        above = (sign + np.eye(n)) / 2
        rank = int(round(np.trace(above)))
        if not 0 < rank < n:
            continue
        # Two steps of subspace iteration: a projector needs one from a generic start.
        start = np.random.default_rng(n).standard_normal((n, rank))
        q, _ = np.linalg.qr(above @ start)
        q, _ = np.linalg.qr(np.hstack([above @ q, start]), mode="complete")
        upper, lower = q[:, :rank], q[:, rank:n]
        coupled = np.linalg.norm(lower.T @ a @ upper)
        if best is None or coupled < best[0]:
            best = (coupled, upper, lower)
        if coupled <= 10 * n * EPS * scale:
            break
    return best and best[1:]


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix, falling."""
    a = (a + a.T) / 2
    n = len(a)
    if not n:
        return np.zeros(0), np.zeros((0, 0))
    scale = np.linalg.norm(a)
    done: list[np.ndarray] = []
    open_spaces = [np.eye(n)]
    while open_spaces:
        basis = open_spaces.pop()
        m = basis.shape[1]
        inner = basis.T @ a @ basis
        inner = (inner + inner.T) / 2
        flat = inner - np.trace(inner) / m * np.eye(m)
        halves = None
        if m > 1 and np.linalg.norm(flat) > 4 * EPS * scale:
            halves = _split(inner, scale)
        if halves is None:
            done.append(basis)
        else:
            open_spaces += [basis @ half for half in halves]
    # Products of many bases drift from orthogonality by rounding alone.
    vectors, r = np.linalg.qr(np.hstack(done))
    vectors = vectors * np.where(np.diag(r) < 0, -1.0, 1.0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
