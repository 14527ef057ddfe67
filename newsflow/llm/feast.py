"""Largest eigenpairs of a symmetric matrix by contour integration.

Inertia counts (signs of the pivots of a shifted tridiagonal form) locate the
wanted eigenvalues and the widest gap below them.  Complex shifted solves on a
circle around that interval, weighted by Gauss quadrature, filter a random
block into its invariant subspace, Rayleigh-Ritz extracts the pairs, and the
count inside the interval must equal the inertia, or the block is doubled, up
to the whole space.  The matrix has the size of a vector, whatever the number
of rows it came from.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Quadrature points on the half circle; refinements of a block; eigenvalues beyond the wanted ones searched for a gap.
NODES, STEPS, BEYOND = 8, 30, 9


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and next diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = a.copy()
    for j in range(len(a) - 2):
        v = a[j + 1:, j].copy()
        norm = np.linalg.norm(v)
        if norm == 0 or not v[1:].any():
            continue
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        a[j + 1:] -= 2 * np.outer(v, v @ a[j + 1:])
        a[:, j + 1:] -= 2 * np.outer(a[:, j + 1:] @ v, v)
    return a.diagonal().copy(), a.diagonal(-1).copy()


def above(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Inertia: how many eigenvalues lie above each shift."""
    diagonal, beside = form
    tiny = EPS * EPS * (np.abs(diagonal).max() + np.abs(beside).max(initial=0)) + np.finfo(float).tiny
    pivot = diagonal[0] - shifts
    count = (pivot > 0).astype(int)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[i] - shifts - beside[i - 1] ** 2 / pivot
        count += pivot > 0
    return count


def kth_largest(form: tuple[np.ndarray, np.ndarray], which: np.ndarray, bound: float) -> np.ndarray:
    """The eigenvalues of rank ``which`` (from 1, falling) by bisection on inertia counts."""
    low, high = np.full(len(which), -bound), np.full(len(which), bound)
    for _ in range(80):
        middle = (low + high) / 2
        more = above(form, middle) >= which
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return (low + high) / 2


def inside(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``, eigenvalues falling."""
    d, norm = len(a), np.linalg.norm(a)
    t, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 + t))
    middle, radius = (low + high) / 2, (high - low) / 2
    rng, size = np.random.default_rng(0), min(d, count + max(4, count // 2))
    while True:
        block = rng.standard_normal((d, size))
        for _ in range(STEPS):
            if size < d:
                block = sum(0.5 * w * (radius * u * np.linalg.solve((middle + radius * u) * np.eye(d) - a, block)).real
                            for w, u in zip(weight, turn))
            q = np.linalg.qr(np.linalg.qr(block)[0])[0]
            value, ritz = np.linalg.eigh(q.T @ a @ q)
            block = q @ ritz
            left = np.linalg.norm(a @ block - block * value, axis=0)
            good = np.flatnonzero((value > low) & (value < high) & (left <= 4 * d * EPS * norm))[::-1]
            if len(good) == count:
                return value[good], block[:, good]
            if size == d:  # the whole space: what the matrix holds in double precision
                good = np.argsort(-value)[:count]
                return value[good], block[:, good]
        size = min(d, 2 * size)


def largest(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest positive eigenvalues (fewer if fewer are positive beyond
    rounding) and their unit eigenvectors as columns, largest entry positive."""
    d, scale = len(a), np.trace(a)
    if not scale > 0:
        return np.zeros(0), np.zeros((d, 0))
    a = a / scale
    form, bound = tridiagonal(a), 1.0 + 1e-9
    k = min(k, int(above(form, np.array([8 * d * EPS]))[0]))
    near = kth_largest(form, np.arange(k, min(d, k + BEYOND) + 1), bound)
    if k + BEYOND >= d:
        near = np.append(near, -near[0])
    gap = int(np.argmax(near[:-1] - near[1:]))
    low = (near[gap] + near[gap + 1]) / 2
    high = kth_largest(form, np.array([1]), bound)[0]
    high += max(0.05 * (high - low), 1e-9)
    value, vector = inside(a, low, high, int(above(form, np.array([low]))[0]))
    value, vector = value[:k], vector[:, :k]
    top = np.abs(vector).argmax(0)
    return value * scale, vector * np.sign(vector[top, np.arange(len(value))])
