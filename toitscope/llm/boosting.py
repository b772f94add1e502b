"""Histogram gradient-boosted trees for two classes, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 120
DEPTH = 4
BINS = 64
RATE = 0.1
RIDGE = 1.0
LEAST_WEIGHT = 1.0


@dataclass
class Forest:
    """Every tree's nodes one after another; a leaf leads to itself. A row goes left when its value is at most the cut."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row, all trees of a row at once."""
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[row, self.feature[node]] <= self.cut[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.bias + self.value[node].sum(axis=1))))


def cuts_of(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper bounds of the bins of a feature: quantiles between distinct values."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Boost ``trees`` trees of logistic loss; a constant when the labels are all alike."""
    n, m = x.shape
    share = float(np.clip(y.mean() if n else 0.5, 1e-9, 1 - 1e-9))
    bias = float(np.log(share / (1 - share)))
    cuts = [cuts_of(x[:, j], bins) if n else np.zeros(0) for j in range(m)]
    wide = bins + 1
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1) if n else None
    nodes: list[list[float]] = []
    roots = []
    total = np.full(n, bias)
    for _ in range(trees if n and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([])
        level = [(len(nodes) - 1, np.arange(n))]
        for deep in range(depth + 1):
            below = []
            for at, rows in level:
                g, h = grad[rows], hess[rows]
                best = best_split(binned[rows], g, h, wide, [len(c) for c in cuts]) if deep < depth else None
                if best is None:
                    value = -RATE * g.sum() / (h.sum() + RIDGE)
                    nodes[at] = [0, np.inf, at, at, value]
                    total[rows] += value
                    continue
                feature, bin_ = best
                goes_left = binned[rows, feature] <= bin_
                nodes[at] = [feature, cuts[feature][bin_], len(nodes), len(nodes) + 1, 0.0]
                nodes += [[], []]
                below += [(len(nodes) - 2, rows[goes_left]), (len(nodes) - 1, rows[~goes_left])]
            level = below
    table = np.array(nodes, float).reshape(-1, 5)
    return Forest(
        table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64),
        table[:, 4], np.array(roots, np.int64), depth, bias,
    )


def best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, wide: int, cuts: list[int]) -> tuple[int, int] | None:
    """Feature and bin whose split gains most, from histograms of gradients over the bins of every feature."""
    m = binned.shape[1]
    place = (binned + np.arange(m) * wide).ravel()
    left_g = np.bincount(place, np.repeat(g, m), m * wide).reshape(m, wide).cumsum(axis=1)
    left_h = np.bincount(place, np.repeat(h, m), m * wide).reshape(m, wide).cumsum(axis=1)
    sum_g, sum_h = g.sum(), h.sum()
    right_g, right_h = sum_g - left_g, sum_h - left_h
    gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - sum_g**2 / (sum_h + RIDGE)
    usable = (left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT) & (np.arange(wide) < np.array(cuts)[:, None])
    gain[~usable] = -np.inf
    at = int(gain.argmax())
    return divmod(at, wide) if gain.flat[at] > 1e-9 else None
