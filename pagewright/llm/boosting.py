"""Gradient-boosted trees for a binary target: histogram splits, level-wise, logistic loss. Deterministic."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 24


@dataclass
class Trees:
    depth: int
    rate: float
    start: float = 0.0
    #: Per tree: the feature and threshold of each inner node in level order, and each leaf's value.
    features: list[np.ndarray] = field(default_factory=list)
    thresholds: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.3, least: float = 1.0) -> Trees:
    """x: rows by features, y: 0 or 1. `least` is added to every sum of second derivatives."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="nearest")) for c in x.T]
    codes = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    width = BINS + 1
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(depth, rate, float(np.log(p / (1 - p))))
    margin = np.full(len(y), model.start)
    inner = 2**depth - 1
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = y - q, q * (1 - q)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            local = at - first
            best, choice = np.full(nodes, 1e-6), [(0, np.inf, BINS)] * nodes
            total_g, total_h = np.bincount(local, g, nodes), np.bincount(local, h, nodes)
            whole = total_g**2 / (total_h + least)
            for f in range(x.shape[1]):
                if not len(cuts[f]):
                    continue
                key = local * width + codes[:, f]
                left_g = np.bincount(key, g, nodes * width).reshape(nodes, width).cumsum(1)[:, : len(cuts[f])]
                left_h = np.bincount(key, h, nodes * width).reshape(nodes, width).cumsum(1)[:, : len(cuts[f])]
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + least) + right_g**2 / (right_h + least) - whole[:, None]
                top = gain.argmax(1)
                for n in np.flatnonzero(gain[np.arange(nodes), top] > best):
                    best[n] = gain[n, top[n]]
                    choice[n] = (f, float(cuts[f][top[n]]), int(top[n]))
            for n, (f, t, _) in enumerate(choice):
                feature[first + n], threshold[first + n] = f, t
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + least)
        margin += value[leaf]
        model.features.append(feature)
        model.thresholds.append(threshold)
        model.leaves.append(value)
    return model
