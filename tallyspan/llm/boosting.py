"""Gradient-boosted regression trees for a yes-or-no label: quantile bins, logistic loss, Newton leaves."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A complete binary tree: `feature` and `edge` of the inner nodes by level, then the leaves' values. Right where x > edge."""

    feature: np.ndarray
    edge: np.ndarray
    leaf: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(int(np.log2(len(self.leaf)))):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.edge[at])
        return self.leaf[at - len(self.feature)]


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.values(x)
        return out


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 5, rate: float = 0.2, bins: int = 24, damping: float = 1.0, least: float = 2.0) -> Boosted:
    """Fits `trees` trees; each split maximises the second-order gain over the bins' edges, none where it gains nothing."""
    edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    used = [f for f, e in enumerate(edges) if len(e)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Boosted(float(np.log(share / (1 - share))), [])
    if not used or not len(y):
        return model
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in used])  # x <= edge k: bin <= k
    logit = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, p * (1 - p) + 1e-9
        feature, edge = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            n = 1 << level
            best = np.full(n, 1e-6)
            choice = [(0, -1)] * n
            for k in range(len(used)):
                m = len(edges[used[k]]) + 1
                cell = at * m + binned[k]
                gs = np.bincount(cell, g, n * m).reshape(n, m).cumsum(1)
                hs = np.bincount(cell, h, n * m).reshape(n, m).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + damping) + (gt - gl) ** 2 / (ht - hl + damping) - gt**2 / (ht + damping)
                gain = np.where((hl >= least / 4) & (ht - hl >= least / 4), gain, 0)
                at_edge = gain.argmax(1)
                top = gain[np.arange(n), at_edge]
                for i in np.flatnonzero(top > best):
                    best[i], choice[i] = top[i], (k, int(at_edge[i]))
            first = n - 1
            right = np.zeros(len(y), np.int64)
            for i, (k, b) in enumerate(choice):
                if b >= 0:
                    feature[first + i], edge[first + i] = used[k], edges[used[k]][b]
                    here = at == i
                    right[here] = binned[k, here] > b
            at = 2 * at + right
        leaf = -rate * np.bincount(at, g, 1 << depth) / (np.bincount(at, h, 1 << depth) + damping)
        logit += leaf[at]
        model.trees.append(Tree(feature, edge, leaf))
    return model


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Where a feature may be split: quantiles, without the largest value."""
    found = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1), method="lower")) if len(values) else values
    distinct = np.unique(values)
    if len(distinct) <= bins:
        found = distinct
    return found[found < distinct[-1]] if len(distinct) else distinct
