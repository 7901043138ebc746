"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into at most 63 quantile bins. Every tree is complete to `depth` and grown level by level from
histograms of gradients; a node without a useful split sends everything left. The trees are flattened into
arrays (tree, node), so that all rows walk all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray  # same shape: a larger value goes right
    leaf: np.ndarray  # (trees, 2**depth)

    def score(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        """Probability of class 1 for each row of x."""
        out = np.empty(len(x))
        if not len(self.leaf):
            out[:] = self.base
            return 1 / (1 + np.exp(-out))
        trees = np.arange(len(self.leaf))[None, :]
        inner = self.feature.shape[1]
        for at in range(0, len(x), block):
            part = x[at : at + block]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(self.leaf)), np.int64)
            while node[0, 0] < inner:
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            out[at : at + block] = self.base + self.leaf[trees, node - inner].sum(1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 5, rate: float = 0.15, ridge: float = 2.0, least: int = 10) -> Trees:
    """Fits labels 0 and 1. Without rows the score is 0.5; with one class it is near that class."""
    inner, features = (1 << depth) - 1, x.shape[1]
    empty = Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(y):
        return empty
    share = (y.sum() + 0.5) / (len(y) + 1)
    empty.base = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return empty
    cuts = []
    binned = np.empty(x.shape, np.int64)
    for j in range(features):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1]))
        cuts.append(q)
        binned[:, j] = np.searchsorted(q, x[:, j], "left")  # bin b: cuts[b-1] < value <= cuts[b]
    margin = np.full(len(y), empty.base)
    all_feature, all_threshold, all_leaf = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = np.full(width, 1e-6)
            for j in range(features):
                if not len(cuts[j]):
                    continue
                cell = local * BINS + binned[:, j]
                gs = np.bincount(cell, g, width * BINS).reshape(width, BINS)
                hs = np.bincount(cell, h, width * BINS).reshape(width, BINS)
                ns = np.bincount(cell, minlength=width * BINS).reshape(width, BINS)
                gl, hl, nl = gs.cumsum(1), hs.cumsum(1), ns.cumsum(1)
                gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(nl < least) | (nt - nl < least)] = -1
                gain = gain[:, : len(cuts[j])]
                cut = gain.argmax(1)
                top = gain[np.arange(width), cut]
                better = top > best
                best = np.where(better, top, best)
                nodes = first + np.flatnonzero(better)
                feature[nodes], threshold[nodes] = j, cuts[j][cut[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        place = node - inner
        leaf = -rate * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + ridge)
        margin += leaf[place]
        all_feature.append(feature), all_threshold.append(threshold), all_leaf.append(leaf)
    return Trees(empty.base, np.array(all_feature), np.array(all_threshold), np.array(all_leaf))
