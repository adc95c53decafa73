"""Gradient-boosted trees on dense features, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of equal depth: split feature and threshold per inner node."""

    start: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, smooth: float = 1.0, least: float = 1.0
) -> Trees:
    """Logistic loss, second-order splits over quantile bins. ``least``: Hessian weight of a child."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    coded = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], 1)
    rate_of = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate_of / (1 - rate_of)))
    margin, inner = np.full(len(x), start), 2**depth - 1
    made = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gains = np.full((x.shape[1], width, bins), -np.inf)
            local = node - first
            for f in range(x.shape[1]):
                at = local * bins + coded[:, f]
                g = np.bincount(at, gradient, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(at, hessian, width * bins).reshape(width, bins).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
                gain[(h < least) | (h_all - h < least)] = -np.inf
                gains[f] = gain
            for k in range(width):
                f, b = divmod(int(gains[:, k].argmax()), bins)
                if gains[f, k, b] > 1e-6 and b < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        local = node - inner
        g = np.bincount(local, gradient, inner + 1)
        h = np.bincount(local, hessian, inner + 1)
        leaf = -rate * g / (h + smooth)
        margin += leaf[local]
        for parts, part in zip(made, (feature, threshold, leaf)):
            parts.append(part)
    return Trees(start, *(np.stack(parts) for parts in made))


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising scores and the calibrated value at each.

    Each block counts one case of either label beside its own, at the base rate's share, so no block
    claims certainty.
    """
    order = np.argsort(score, kind="stable")
    score, y = score[order], y[order].astype(float)
    base = y.mean()
    blocks: list[list[float]] = []  # sum, weight, first score, last score
    for s, value in zip(score, y):
        blocks.append([value, 1.0, s, s])
        while len(blocks) > 1 and (
            blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]
        ):
            total, weight, _, last = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += weight
            blocks[-1][3] = last
    xs = np.array([end for b in blocks for end in (b[2], b[3])])
    ys = np.array([(b[0] + base) / (b[1] + 1) for b in blocks for _ in (0, 1)])
    ys = np.maximum.accumulate(ys)
    return xs, ys
