"""Gradient-boosted trees for two classes on a bounded table, in numpy."""

from __future__ import annotations

import numpy as np

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def fit(
    x: np.ndarray,
    y: np.ndarray,
    w: np.ndarray,
    start: np.ndarray,
    trees: int = 50,
    depth: int = 3,
    rate: float = 0.3,
) -> list[Tree]:
    """Trees that correct the margins `start`; a tree is its split features, split
    values and leaf values."""
    if not len(x):
        return []
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 31))) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    bins = max(len(c) for c in cuts) + 1
    margin, made = start.astype(float).copy(), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (y - p), w * np.maximum(p * (1 - p), 1e-6)
        feature = np.zeros((1 << depth) - 1, dtype=np.int64)
        value = np.full((1 << depth) - 1, np.inf)
        at = np.zeros(len(x), dtype=np.int64)
        for level in range(depth):
            first = (1 << level) - 1
            best, split = np.full(1 << level, 1e-6), [(0, -1)] * (1 << level)
            for j, c in enumerate(cuts):
                cell = (at - first) * bins + binned[:, j]
                gs = np.bincount(cell, g, (1 << level) * bins).reshape(-1, bins).cumsum(1)
                hs = np.bincount(cell, h, (1 << level) * bins).reshape(-1, bins).cumsum(1)
                gl, hl = gs[:, : len(c)], hs[:, : len(c)]
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                for node in range(1 << level):
                    k = int(gain[node].argmax())
                    if gain[node, k] > best[node]:
                        best[node], split[node] = gain[node, k], (j, k)
            for node, (j, k) in enumerate(split):
                if k >= 0:
                    feature[first + node], value[first + node] = j, cuts[j][k]
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > value[at])
        leaf = at - ((1 << depth) - 1)
        leaves = rate * np.bincount(leaf, g, 1 << depth) / (np.bincount(leaf, h, 1 << depth) + 1)
        margin += leaves[leaf]
        made.append((feature, value, leaves))
    return made


def margins(x: np.ndarray, trees: list[Tree]) -> np.ndarray:
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, value, leaves in trees:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(int(np.log2(len(leaves)))):
            at = 2 * at + 1 + (x[rows, feature[at]] > value[at])
        total += leaves[at - len(feature)]
    return total
