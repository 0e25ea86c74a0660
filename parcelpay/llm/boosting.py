"""Gradient-boosted trees over small integer features, trained on counts and applied as one column expression."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from math import exp

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TREES, DEPTH, RATE, LEAST_WEIGHT = 30, 3, 0.3, 5.0


@dataclass(frozen=True)
class Node:
    """A leaf with a value, or a split of feature <= at."""

    value: float = 0.0
    feature: int = -1
    at: int = 0
    low: "Node | None" = None
    high: "Node | None" = None


def tree(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, weight: np.ndarray, depth: int) -> Node:
    """The split with the largest gain in the second-order loss, and below it the same again."""
    score = lambda g, h: g * g / (h + 1.0)
    g, h = gradient.sum(), hessian.sum()
    best = (1e-6, None)
    if depth:
        for f in range(x.shape[1]):
            for at in np.unique(x[:, f])[:-1]:
                low = x[:, f] <= at
                if min(weight[low].sum(), weight[~low].sum()) < LEAST_WEIGHT:
                    continue
                gain = score(gradient[low].sum(), hessian[low].sum()) + score(gradient[~low].sum(), hessian[~low].sum()) - score(g, h)
                if gain > best[0]:
                    best = (gain, (f, int(at), low))
    if best[1] is None:
        return Node(value=float(RATE * g / (h + 1.0)))
    f, at, low = best[1]
    part = lambda rows: tree(x[rows], gradient[rows], hessian[rows], weight[rows], depth - 1)
    return Node(feature=f, at=at, low=part(low), high=part(~low))


def value(node: Node, x: np.ndarray) -> np.ndarray:
    if node.low is None:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] <= node.at, value(node.low, x), value(node.high, x))


@dataclass(frozen=True)
class Boosted:
    names: tuple[str, ...]
    start: float
    trees: tuple[Node, ...]

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((value(t, x) for t in self.trees), np.zeros(len(x)))

    def column(self, feature: Callable[[str], Column]) -> Column:
        """The logarithm of the odds, as nested conditions."""

        def of(node: Node) -> Column:
            if node.low is None:
                return F.lit(node.value)
            return F.when(feature(self.names[node.feature]) <= node.at, of(node.low)).otherwise(of(node.high))

        total = F.lit(self.start)
        for t in self.trees:
            total = total + of(t)
        return total


def train(names: Sequence[str], rows: Sequence[Mapping[str, int]], positive: Sequence[float], negative: Sequence[float]) -> Boosted:
    """Trees for logistic loss from distinct feature rows with their numbers of positive and negative cases."""
    x = np.array([[r[n] for n in names] for r in rows], dtype=np.int64).reshape(len(rows), len(names))
    p, n = np.array(positive, dtype=float), np.array(negative, dtype=float)
    start = float(np.log((p.sum() + 1) / (n.sum() + 1)))
    odds, trees = np.full(len(rows), start), []
    for _ in range(TREES if len(rows) else 0):
        chance = 1 / (1 + np.exp(-odds))
        grown = tree(x, p * (1 - chance) - n * chance, (p + n) * chance * (1 - chance), p + n, DEPTH)
        trees.append(grown)
        odds = odds + value(grown, x)
    return Boosted(tuple(names), start, tuple(trees))


def chance(odds: float) -> float:
    return 1 / (1 + exp(-odds))


def threshold(odds: np.ndarray, positive: np.ndarray, negative: np.ndarray, precision: float) -> float:
    """The lowest odds from which on cases are right with the given precision; infinite if there are none."""
    order = np.argsort(-odds, kind="stable")
    p, n = np.cumsum(positive[order]), np.cumsum(negative[order])
    ends = np.append(odds[order][1:] != odds[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = ends & (p >= precision * (p + n)) & (p > 0)
    return float(odds[order][good].min()) if good.any() else float("inf")
