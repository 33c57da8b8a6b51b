"""Gradient boosting of small trees over counted feature vectors.

Training data are distinct vectors of small whole numbers with the number of rows that
have each, so what is fitted here is bounded by the features' ranges, not by the data.
A fitted model becomes a Spark column: nested ``when`` expressions, no Python at scoring.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 30
RATE = 0.3
DEPTH = 3
#: Weight added to a leaf's curvature, so that few rows move it little.
SHRINK = 4.0
#: Margins this near are calibrated together.
STEP = 0.5


@dataclass(frozen=True)
class Tree:
    """A leaf with ``value``, or a split: rows with feature <= cut go left."""

    value: float = 0.0
    feature: str = ""
    cut: int = 0
    left: Tree | None = None
    right: Tree | None = None

    def apply(self, row: dict[str, int]) -> float:
        node = self
        while node.left is not None:
            node = node.left if row[node.feature] <= node.cut else node.right
        return node.value

    def column(self, features: dict[str, Column]) -> Column:
        if self.left is None:
            return F.lit(self.value)
        return F.when(
            features[self.feature] <= self.cut, self.left.column(features)
        ).otherwise(self.right.column(features))


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def margin(self, row: dict[str, int]) -> float:
        return self.start + sum(tree.apply(row) for tree in self.trees)

    def column(self, features: dict[str, Column]) -> Column:
        """The log odds of a row with the given features."""
        return sum((tree.column(features) for tree in self.trees), F.lit(self.start))


#: A counted vector: features, label, number of rows.
Counted = tuple[dict[str, int], int, int]


def fit(rows: list[Counted], rounds: int = ROUNDS, depth: int = DEPTH) -> Boosted:
    """Boosted trees for the log odds of label 1."""
    total = sum(n for _, _, n in rows)
    ones = sum(n for _, label, n in rows if label)
    start = math.log((ones + 1) / (total - ones + 1))
    margins = [start] * len(rows)
    trees = []
    for _ in range(rounds):
        slopes, curves = [], []
        for (_, label, n), margin in zip(rows, margins):
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, margin))))
            slopes.append(n * (label - p))
            curves.append(n * p * (1 - p))
        tree = _grow(rows, slopes, curves, list(range(len(rows))), depth)
        if tree.left is None and not tree.value:
            break
        trees.append(tree)
        margins = [m + tree.apply(row) for m, (row, _, _) in zip(margins, rows)]
    return Boosted(start, tuple(trees))


def _gain(slope: float, curve: float) -> float:
    return slope * slope / (curve + SHRINK)


def _grow(rows: list[Counted], slopes, curves, at: list[int], depth: int) -> Tree:
    slope, curve = sum(slopes[i] for i in at), sum(curves[i] for i in at)
    best = (1e-6, "", 0)
    if depth and at:
        for feature in rows[at[0]][0]:
            sums: dict[int, list[float]] = {}
            for i in at:
                own = sums.setdefault(rows[i][0][feature], [0.0, 0.0])
                own[0] += slopes[i]
                own[1] += curves[i]
            s = c = 0.0
            for value in sorted(sums)[:-1]:
                s, c = s + sums[value][0], c + sums[value][1]
                gain = _gain(s, c) + _gain(slope - s, curve - c) - _gain(slope, curve)
                best = max(best, (gain, feature, value), key=lambda b: b[0])
    gain, feature, cut = best
    if not feature:
        return Tree(RATE * slope / (curve + SHRINK))
    left = [i for i in at if rows[i][0][feature] <= cut]
    right = [i for i in at if rows[i][0][feature] > cut]
    return Tree(
        0.0,
        feature,
        cut,
        _grow(rows, slopes, curves, left, depth - 1),
        _grow(rows, slopes, curves, right, depth - 1),
    )


def threshold(model: Boosted, rows: list[Counted], precision: float) -> float | None:
    """The lowest margin from which at least ``precision`` of the rows have label 1.

    That share of the margin's own rows must have it too: a surplus of label 1 above lets
    no group of the other label in.
    """
    by_margin: dict[float, list[int]] = {}
    for row, label, n in rows:
        own = by_margin.setdefault(round(model.margin(row), 9), [0, 0])
        own[label] += n
    found, zeros, ones = None, 0, 0
    for margin in sorted(by_margin, reverse=True):
        zeros += by_margin[margin][0]
        ones += by_margin[margin][1]
        own = by_margin[margin]
        if ones >= precision * (zeros + ones) and own[1] >= precision * sum(own):
            found = margin
    return found


def unlabelled_threshold(
    model: Boosted,
    rows: list[tuple[dict[str, int], bool, int, int]],
    precision: float,
    share: float,
    chance: float,
) -> float | None:
    """The lowest margin from which at least ``precision`` of the unsure rows are positive.

    Rows are (features, surely positive, evidence 0 or 1, number). Evidence turns up for
    ``share`` of the positive rows and ``chance`` of the others, so of n unsure rows with
    evidence for e, (e - chance * n) / (share - chance) are positive. Rows of nearly the
    same margin are taken together; a group whose own share is too low, by more than two
    standard errors, ends the search.
    """
    groups: dict[int, list[int]] = {}
    for row, sure, evident, n in rows:
        own = groups.setdefault(math.floor(model.margin(row) / STEP + 1e-9), [0, 0])
        if not sure:
            own[0] += n
            own[1] += n * evident

    def enough(n: int, evident: int, errors: int) -> bool:
        slack = errors * math.sqrt(n * share * (1 - share))
        return evident - chance * n + slack >= precision * (share - chance) * n

    found, all_n, all_evident = None, 0, 0
    for group in sorted(groups, reverse=True):
        n, evident = groups[group]
        all_n, all_evident = all_n + n, all_evident + evident
        if not enough(n, evident, 2):
            break
        if enough(all_n, all_evident, 0):
            found = group * STEP
    return found
