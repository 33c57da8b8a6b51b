"""Gradient-boosted trees with monotonic constraints, flattened into node arrays.

Trees are grown on a bounded sample, by histograms: a feature's values are told apart by
at most ``BINS`` quantiles of the sample. For a constrained feature a split is allowed
only if its sides' values differ in the feature's direction, and the values below each
side are kept on their side of the middle; every tree is then monotonic in it, and so is
their sum, whatever the other features are.

All nodes of all trees lie in five arrays. Rows are scored together: a matrix of row by
tree holds the node where each row stands and takes one step a level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

ROUNDS = 80
RATE = 0.15
DEPTH = 4
BINS = 32
#: Weight added to a node's curvature, so that few rows move it little.
SHRINK = 4.0
#: Curvature that each side of a split has at least.
LEAST_CURVE = 1.0


@dataclass(frozen=True)
class Forest:
    """Node ``i`` sends a row with ``x[feature[i]] <= cut[i]`` to ``left[i]``, else right.

    A leaf leads to itself, so that rows in shallow leaves wait there.
    """

    start: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The log odds of each row of ``x``."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.cut[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return self.start + self.value[at].sum(axis=1)


def probabilities(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -50, 50)))


class _Nodes:
    """The arrays of a forest while it grows."""

    def __init__(self):
        self.feature: list[int] = []
        self.cut: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []

    def leaf(self, value: float) -> int:
        node = len(self.value)
        self.feature.append(0)
        self.cut.append(np.inf)
        self.left.append(node)
        self.right.append(node)
        self.value.append(value)
        return node

    def split(self, node: int, feature: int, cut: float, left: int, right: int) -> None:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = left, right


@dataclass(frozen=True)
class _Growth:
    """What the nodes of one tree have in common."""

    binned: np.ndarray
    cuts: list[np.ndarray]
    directions: Sequence[int]
    slopes: np.ndarray
    curves: np.ndarray
    nodes: _Nodes

    def grow(self, at: np.ndarray, depth: int, low: float, high: float) -> int:
        """The node of the rows ``at``, whose value stays within ``low`` and ``high``."""
        slope, curve = self.slopes[at].sum(), self.curves[at].sum()
        own = _weight(slope, curve, low, high)
        node = self.nodes.leaf(RATE * float(own))
        best = self._best_split(at, slope, curve, low, high) if depth else None
        if best is None:
            return node
        feature, bin_, weights = best
        left_bounds = right_bounds = (low, high)
        if self.directions[feature]:
            middle = sum(weights) / 2
            below, above = (low, middle), (middle, high)
            ordered = (below, above) if self.directions[feature] > 0 else (above, below)
            left_bounds, right_bounds = ordered
        goes_left = self.binned[at, feature] <= bin_
        left = self.grow(at[goes_left], depth - 1, *left_bounds)
        right = self.grow(at[~goes_left], depth - 1, *right_bounds)
        self.nodes.split(node, feature, float(self.cuts[feature][bin_]), left, right)
        return node

    def _best_split(self, at, slope, curve, low, high):
        floor = _quality(slope, curve, _weight(slope, curve, low, high)) + 1e-6
        best = None
        for feature, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            bins = self.binned[at, feature]
            size = len(cuts) + 1
            s = np.cumsum(np.bincount(bins, self.slopes[at], size))[:-1]
            c = np.cumsum(np.bincount(bins, self.curves[at], size))[:-1]
            left = _weight(s, c, low, high)
            right = _weight(slope - s, curve - c, low, high)
            gain = _quality(s, c, left) + _quality(slope - s, curve - c, right)
            allowed = (c >= LEAST_CURVE) & (curve - c >= LEAST_CURVE)
            allowed &= (right - left) * self.directions[feature] >= 0
            gain = np.where(allowed, gain, -np.inf)
            bin_ = int(np.argmax(gain))
            if gain[bin_] > floor:
                floor, best = gain[bin_], (feature, bin_, (left[bin_], right[bin_]))
        return best


def _weight(slope, curve, low, high):
    return np.clip(slope / (curve + SHRINK), low, high)


def _quality(slope, curve, weight):
    """How much the rows' loss falls if they get ``weight``."""
    return weight * slope - weight * weight * (curve + SHRINK) / 2


def fit(
    x: np.ndarray,
    y: np.ndarray,
    directions: Sequence[int],
    rounds: int = ROUNDS,
    depth: int = DEPTH,
) -> Forest:
    """Trees for the log odds of ``y``; ``directions``: 1 rising, -1 falling, 0 free.

    Without rows, or with one label only, there are no trees: every row gets the odds of
    the labels, one of each added.
    """
    ones, n = float(y.sum()), len(y)
    start = float(np.log((ones + 1) / (n - ones + 1)))
    nodes = _Nodes()
    roots = []
    if 0 < ones < n:
        places = np.linspace(0, 1, BINS + 1)[1:-1]
        columns = [x[:, f] for f in range(x.shape[1])]
        # A cut is a value of the sample; the largest one would leave nothing above it.
        cuts = [np.unique(np.quantile(c, places, method="lower")) for c in columns]
        cuts = [c[c < column.max()] for c, column in zip(cuts, columns)]
        binned = np.column_stack([np.searchsorted(c, v) for c, v in zip(cuts, columns)])
        margins, every = np.full(n, start), np.arange(n)
        for _ in range(rounds):
            p = probabilities(margins)
            growth = _Growth(binned, cuts, directions, y - p, p * (1 - p), nodes)
            roots.append(growth.grow(every, depth, -np.inf, np.inf))
            margins = _forest(start, roots, nodes, depth).margins(x)
    return _forest(start, roots, nodes, depth)


def _forest(start: float, roots: list[int], nodes: _Nodes, depth: int) -> Forest:
    return Forest(
        start,
        np.array(roots, np.int64),
        np.array(nodes.feature, np.int64),
        np.array(nodes.cut, np.float64),
        np.array(nodes.left, np.int64),
        np.array(nodes.right, np.int64),
        np.array(nodes.value, np.float64),
        depth,
    )
