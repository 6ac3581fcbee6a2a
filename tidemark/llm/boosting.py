"""Gradient-boosted trees: trained with numpy over a bounded sample, applied as a SQL expression."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cuts tried for each feature, at most.
CUTS = 24


@dataclass
class Node:
    """A split (feature < cut goes left), or a leaf with a value."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Boosted:
    """Log-odds of label 1: a base and the sum of the trees."""

    base: float
    trees: list[Node] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            self._add(tree, x, np.arange(len(x)), out)
        return out

    def _add(self, node: Node, x, rows, out) -> None:
        if node.left is None:
            out[rows] += node.value
            return
        low = x[rows, node.feature] < node.cut
        self._add(node.left, x, rows[low], out)
        self._add(node.right, x, rows[~low], out)

    def column(self, features: list[Column]) -> Column:
        """The same log-odds over feature columns."""
        out = F.lit(self.base)
        for tree in self.trees:
            out = out + self._column(tree, features)
        return out

    def _column(self, node: Node, features: list[Column]) -> Column:
        if node.left is None:
            return F.lit(node.value)
        return F.when(features[node.feature] < node.cut, self._column(node.left, features)).otherwise(self._column(node.right, features))


def _grow(x, gradient, hessian, rows, depth: int, rate: float, cuts: list[np.ndarray]) -> Node:
    g, h = gradient[rows].sum(), hessian[rows].sum()
    leaf = Node(value=float(rate * g / (h + 1)))
    if depth == 0 or len(rows) < 10:
        return leaf
    best = (1e-6, -1, 0.0)
    for f, tried in enumerate(cuts):
        for cut in tried:
            low = x[rows, f] < cut
            gl, hl = gradient[rows[low]].sum(), hessian[rows[low]].sum()
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            if gain > best[0] and 0 < low.sum() < len(rows):
                best = (gain, f, float(cut))
    if best[1] < 0:
        return leaf
    low = x[rows, best[1]] < best[2]
    sides = [_grow(x, gradient, hessian, part, depth - 1, rate, cuts) for part in (rows[low], rows[~low])]
    return Node(feature=best[1], cut=best[2], left=sides[0], right=sides[1])


def boost(x: np.ndarray, y: np.ndarray, trees: int = 20, depth: int = 3, rate: float = 0.3) -> Boosted:
    """Trees for label y in {0, 1} by Newton steps on the logistic loss."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Boosted(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middle = (values[1:] + values[:-1]) / 2
        cuts.append(middle[np.unique(np.linspace(0, len(middle) - 1, CUTS).astype(int))] if len(middle) > CUTS else middle)
    margin = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, y - p, p * (1 - p), np.arange(len(y)), depth, rate, cuts)
        model.trees.append(tree)
        model._add(tree, x, np.arange(len(y)), margin)
    return model
