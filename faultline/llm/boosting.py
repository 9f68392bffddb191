"""Gradient-boosted trees for a yes/no target, on histograms of bounded training data."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 24


@dataclass(frozen=True)
class Boosted:
    """Complete trees of one depth; a row goes right where its feature is over the cut."""

    start: float
    features: np.ndarray  # [trees, inner nodes]
    cuts: np.ndarray
    leaves: np.ndarray  # [trees, leaves]

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        inner = self.features.shape[1]
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(rows), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (rows[every, feature[at]] > cut[at])
            total += leaf[at - inner]
        return total


def fit(rows: np.ndarray, target: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    """Newton steps on the logistic loss; cuts are quantiles of each feature."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(n, start)
    inner = 2**depth - 1
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = target - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = at - first
            best = np.zeros(count)
            all_g, all_h = (np.bincount(local, x, count) for x in (grad, hess))
            for f, edge in enumerate(edges):
                size = len(edge) + 1
                cell = local * size + binned[:, f]
                g, h = (np.bincount(cell, x, count * size).reshape(count, size).cumsum(axis=1)[:, :-1] for x in (grad, hess))
                right_g, right_h = all_g[:, None] - g, all_h[:, None] - h
                gain = g**2 / (h + ridge) + right_g**2 / (right_h + ridge) - (all_g**2 / (all_h + ridge))[:, None]
                gain[(h < 1e-6) | (right_h < 1e-6)] = 0
                pick = gain.argmax(axis=1)
                value = gain[np.arange(count), pick]
                better = value > best + 1e-9
                best[better] = value[better]
                feature[first : first + count][better] = f
                cut[first : first + count][better] = edge[pick[better]]
            at = 2 * at + 1 + (rows[np.arange(n), feature[at]] > cut[at])
        local = at - inner
        g, h = (np.bincount(local, x, inner + 1) for x in (grad, hess))
        leaf = rate * g / (h + ridge)
        total += leaf[local]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Boosted(start, np.array(features), np.array(cuts), np.array(leaves))
