"""Small gradient-boosted trees in numpy, for training sets of a bounded size."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Node:
    value: float
    feature: int = -1
    threshold: float = 0.0  # left: x <= threshold
    left: "Node | None" = None
    right: "Node | None" = None


@dataclass
class Boosted:
    base: float
    trees: list[Node] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += _values(tree, x)
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _values(node: Node, x: np.ndarray) -> np.ndarray:
    if node.left is None:
        return np.full(len(x), node.value)
    low = x[:, node.feature] <= node.threshold
    out = np.empty(len(x))
    out[low] = _values(node.left, x[low])
    out[~low] = _values(node.right, x[~low])
    return out


def cut_points(x: np.ndarray, bins: int = 32) -> list[np.ndarray]:
    """Candidate thresholds of every column: midpoints at its quantiles."""
    points = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1), method="nearest"))
        points.append((values[1:] + values[:-1]) / 2)
    return points


def fit_boosted(
    x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3,
    least: int = 10, share: float = 1.0, seed: int = 7, ridge: float = 1.0,
) -> Boosted:
    """Logistic boosting; ``share`` is the part of the rows that each tree sees."""
    rng = np.random.default_rng(seed)
    points = cut_points(x)
    codes = np.stack(
        [np.searchsorted(p, c, "left") for p, c in zip(points, x.T)], axis=1
    ).astype(np.int64) if x.shape[1] else np.zeros((len(x), 0), np.int64)
    rate0 = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Boosted(float(np.log(rate0 / (1 - rate0))))
    raw = np.full(len(x), model.base)
    for _ in range(rounds):
        p = sigmoid(raw)
        rows = np.flatnonzero(rng.random(len(x)) < share) if share < 1 else np.arange(len(x))
        tree = _grow(codes, points, p - y, p * (1 - p), rows, depth, rate, least, ridge)
        if tree.left is None:
            break
        model.trees.append(tree)
        raw += _values(tree, x)
    return model


def _grow(codes, points, gradient, hessian, rows, depth, rate, least, ridge) -> Node:
    g, h = gradient[rows].sum(), hessian[rows].sum()
    node = Node(float(-rate * g / (h + ridge)))
    if depth == 0 or len(rows) < 2 * least:
        return node
    best = (1e-6, -1, 0)
    for f, cuts in enumerate(points):
        if not len(cuts):
            continue
        code = codes[rows, f]
        n = np.cumsum(np.bincount(code, minlength=len(cuts) + 1))[:-1]
        gl = np.cumsum(np.bincount(code, gradient[rows], len(cuts) + 1))[:-1]
        hl = np.cumsum(np.bincount(code, hessian[rows], len(cuts) + 1))[:-1]
        gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
        gain[(n < least) | (len(rows) - n < least)] = -1
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    if best[1] >= 0:
        _, node.feature, k = best
        node.threshold = float(points[node.feature][k])
        low = codes[rows, node.feature] <= k
        args = (depth - 1, rate, least, ridge)
        node.left = _grow(codes, points, gradient, hessian, rows[low], *args)
        node.right = _grow(codes, points, gradient, hessian, rows[~low], *args)
    return node


def paths(node: Node, so_far: tuple = ()) -> list[tuple]:
    """Every path from the root, as a conjunction of (feature, is_at_most, threshold)."""
    out = [so_far] if so_far else []
    if node.left is not None:
        out += paths(node.left, (*so_far, (node.feature, True, node.threshold)))
        out += paths(node.right, (*so_far, (node.feature, False, node.threshold)))
    return out
