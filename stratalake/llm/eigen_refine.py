"""Eigenvectors of a symmetric matrix from a float32 solution, refined by matrix products.

The iteration of Ogita and Aishima (2018): for approximate eigenvectors X of A let
R = I - X'X, S = X'AX, l_i = s_ii / (1 - r_ii); then X + XE, with
e_ij = (s_ij + l_j r_ij) / (l_j - l_i), or r_ij / 2 where l_i and l_j are closer than the
present errors can tell apart, has about the square of X's error. It runs in float64
first and then in numpy's longdouble, which has more digits than a double on common
machines, so that the vectors are good to double precision.

Eigenvalues too close to tell apart form a cluster. Its vectors span the right space, but
are mixed within it. As in the second part of that work (2019) a cluster is solved by
itself: the matrix is shifted by the cluster's middle, projected onto its span and solved
there, where differences within the cluster are no longer small against the numbers
around them; the span is turned accordingly and the iteration goes on.
"""

from __future__ import annotations

import numpy as np

STEPS = 12


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    The largest component of each vector is positive. Vectors of equal eigenvalues are
    some orthonormal basis of their space.
    """
    exact = np.asarray(matrix, np.longdouble)
    exact = (exact + exact.T) / 2
    scale = np.abs(exact).max(initial=0)
    if not scale:
        return np.zeros(len(exact)), np.eye(len(exact))
    exact = exact / scale
    x = np.linalg.eigh(exact.astype(np.float32))[1].astype(np.float64)
    for kind in (np.float64, np.longdouble):
        x = _refined(exact.astype(kind), x.astype(kind))
    values = np.einsum("ij,ij->j", x, exact @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt(np.einsum("ij,ij->j", x, x))[order]
    signs = np.where(x[np.abs(x).argmax(axis=0), np.arange(len(x))] < 0, -1, 1)
    return (values[order] * scale).astype(np.float64), (x * signs).astype(np.float64)


def _refined(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Steps until they no longer get smaller."""
    enough = 4 * len(a) * np.finfo(a.dtype).eps
    last = np.inf
    for _ in range(STEPS):
        x, change, clusters = step(a, x)
        for cluster in clusters:
            x[:, cluster] = solved_within(a, x[:, cluster])
        if change <= enough or change > last / 2 and not clusters:
            break
        last = change
    return _orthonormal(x)


def step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float, list[np.ndarray]]:
    """One step: the new vectors, the size of the change, and the clusters (as columns)."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    # Rounding that differs on the two sides would be divided by small gaps.
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    # Frobenius norms are upper bounds of the spectral ones and exist for longdouble.
    error = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > error
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
    return x + x @ e, float(np.abs(e).max()), _clusters(values, error)


def _clusters(values: np.ndarray, error) -> list[np.ndarray]:
    """Sets of two or more columns whose values form a chain of gaps within ``error``."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > error) + 1
    return [c for c in np.split(order, breaks) if len(c) > 1]


def solved_within(a: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The vectors of one cluster, turned to eigenvectors of ``a`` within their span."""
    span = _orthonormal(span)
    product = a @ span
    middle = np.einsum("ij,ij->", span, product) / span.shape[1]
    within = span.T @ (product - middle * span)
    within = (within + within.T) / 2
    size = np.abs(within).max()
    if not size:
        return span
    turn = np.linalg.eigh((within / size).astype(np.float64))[1]
    return span @ turn.astype(a.dtype)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns that are orthonormal up to some error, with about the square of it."""
    return x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2


def _norm(m: np.ndarray):
    return np.sqrt((m * m).sum())
