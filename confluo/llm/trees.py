"""Gradient-boosted trees for small training samples, fitted on the driver and used inside tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

Condition = tuple[int, bool, float]  # feature, True for "at most", threshold


@dataclass
class Tree:
    """Nodes in order of creation; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(x)
        return len(self.value) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right, node = np.array(self.left), np.array(self.right), np.zeros(len(x), int)
        while True:
            inner = np.flatnonzero(feature[node] >= 0)
            if not len(inner):
                return np.array(self.value)[node]
            at = node[inner]
            node[inner] = np.where(x[inner, feature[at]] <= threshold[at], left[at], right[at])

    def paths(self) -> list[tuple[Condition, ...]]:
        """The conjunction that leads to every node but the root."""
        out: list[tuple[Condition, ...]] = []

        def walk(node: int, path: tuple[Condition, ...]) -> None:
            if path:
                out.append(path)
            if self.feature[node] >= 0:
                walk(self.left[node], (*path, (self.feature[node], True, self.threshold[node])))
                walk(self.right[node], (*path, (self.feature[node], False, self.threshold[node])))

        walk(0, ())
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Thresholds halfway between quantiles of each feature."""
    out = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1), method="nearest")) if len(column) else np.array([])
        out.append((values[1:] + values[:-1]) / 2)
    return out


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.predict(x)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def fit_boosted(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 10.0, ridge: float = 1.0) -> Boosted:
    """Second-order boosting for the logistic loss on binned features."""
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(mean / (1 - mean))), [])
    if len(np.unique(y)) < 2:
        return model
    cuts = cut_points(x, bins)
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    raw = np.full(len(y), model.base)
    for _ in range(rounds):
        p = sigmoid(raw)
        tree = _grow(binned, cuts, p - y, np.maximum(p * (1 - p), 1e-6), depth, rate, least, ridge)
        if tree.feature[0] < 0:
            break
        model.trees.append(tree)
        raw += tree.predict(x)
    return model


def _grow(binned, cuts, gradient, curve, depth, rate, least, ridge) -> Tree:
    tree = Tree()

    def leaf(rows: np.ndarray) -> int:
        return tree.add(float(-rate * gradient[rows].sum() / (curve[rows].sum() + ridge)))

    def split(node: int, rows: np.ndarray, deep: int) -> None:
        if deep == depth or len(rows) < 2 * least:
            return
        g, h, best = gradient[rows], curve[rows], (1e-6, -1, 0)
        whole = g.sum() ** 2 / (h.sum() + ridge)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            size = len(cut) + 1
            bins = binned[rows, f]
            gl, hl = np.cumsum(np.bincount(bins, g, size))[:-1], np.cumsum(np.bincount(bins, h, size))[:-1]
            nl = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            gain = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - whole
            gain[(nl < least) | (len(rows) - nl < least)] = -1
            if gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
        if best[1] < 0:
            return
        _, f, at = best
        low = binned[rows, f] <= at
        tree.feature[node], tree.threshold[node] = f, float(cuts[f][at])
        tree.left[node], tree.right[node] = leaf(rows[low]), leaf(rows[~low])
        split(tree.left[node], rows[low], deep + 1)
        split(tree.right[node], rows[~low], deep + 1)

    everything = np.arange(len(gradient))
    split(leaf(everything), everything, 0)
    return tree


def fit_lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and sparse weights of a logistic model, by accelerated proximal gradient; the intercept is not penalised."""
    n, k = x.shape
    weights, bias, ahead, ahead_bias, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    step = 4.0 / (np.linalg.norm(np.column_stack([x, np.ones(n)]), 2) ** 2 / n + 1e-9)
    for _ in range(rounds):
        off = (sigmoid(x @ ahead + ahead_bias) - y) / n
        moved = ahead - step * (x.T @ off)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_bias = ahead_bias - step * off.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = new + (t - 1) / t_new * (new - weights), new_bias + (t - 1) / t_new * (new_bias - bias)
        weights, bias, t = new, new_bias, t_new
    return bias, weights
