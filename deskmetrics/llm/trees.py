"""Histogram gradient-boosted trees for a yes/no label, in numpy.

Features are binned at quantiles once; each tree grows level by level from histograms of
gradients and hessians, so fitting reads a bounded sample some hundred times and never sorts
again. A fitted model is a handful of flat arrays: tree t is a complete binary tree, node k's
children are 2k + 1 and 2k + 2, and all rows walk down a level with one indexed comparison.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """``feature`` and ``threshold``: (trees, inner nodes); ``value``: (trees, leaves); ``base``: log-odds."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row of ``x``."""
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0,
    least: float = 2.0, weight: np.ndarray | None = None,
) -> Trees:
    """Boosted trees for labels 0 and 1. Without rows the score is 0.5 everywhere; with one class, near its label."""
    n, k = x.shape
    inner = (1 << depth) - 1
    weight = np.ones(n) if weight is None else weight
    total = weight.sum()
    rate_one = (float((y * weight).sum()) + 0.5) / (total + 1.0)
    base = float(np.log(rate_one / (1 - rate_one)))
    if not n or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int32), np.zeros((0, inner)), np.zeros((0, inner + 1)), base if n else 0.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    features, thresholds, values = [], [], []
    f = np.full(n, base)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-f))
        g, h = (p - y) * weight, p * (1 - p) * weight
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int32), np.full(inner, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best_gain = np.full(width, 1e-6)
            best = np.zeros((width, 2), np.int64)
            own = node - first
            for j in range(k):
                size = len(edges[j]) + 1
                if size == 1:
                    continue
                at = own * size + binned[:, j]
                hg = np.bincount(at, g, width * size).reshape(width, size).cumsum(1)
                hh = np.bincount(at, h, width * size).reshape(width, size).cumsum(1)
                lg, lh = hg[:, :-1], hh[:, :-1]
                rg, rh = hg[:, -1:] - lg, hh[:, -1:] - lh
                gain = lg**2 / (lh + l2) + rg**2 / (rh + l2) - hg[:, -1:] ** 2 / (hh[:, -1:] + l2)
                gain[(lh < least * 0.05) | (rh < least * 0.05)] = 0
                cut = gain.argmax(1)
                top = gain[np.arange(width), cut]
                better = top > best_gain
                best_gain[better] = top[better]
                best[better] = np.stack([np.full(width, j), cut], 1)[better]
            split = best_gain > 1e-6
            cuts = np.full(width, 1 << 30)
            cuts[split] = best[split, 1]
            feature[first : first + width] = best[:, 0]
            for w in np.flatnonzero(split):
                threshold[first + w] = edges[best[w, 0]][best[w, 1]]
            node = 2 * node + 1 + (binned[np.arange(n), best[own, 0]] > cuts[own])
        leaf = node - inner
        lg = np.bincount(leaf, g, inner + 1)
        lh = np.bincount(leaf, h, inner + 1)
        value = -rate * lg / (lh + l2)
        f += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), base)
