"""Gradient-boosted trees for two classes in numpy: histogram splits, logistic loss, depth-wise complete trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth as arrays; small enough to travel with a task."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def raw(self, x: np.ndarray, bins: dict[int, np.ndarray] | None = None) -> np.ndarray:
        """Log-odds of the positive class. ``bins`` keeps binned features for other trees fitted on the same ones."""
        bins = {} if bins is None else bins
        out = np.full(len(x), self.base)
        if not len(x) or not len(self.feature):
            return out
        used = np.unique(self.feature)
        # one row of bins per feature, so that a whole row is written at once; all trees go down a level together, some lines at a time
        for j in used:
            if j not in bins:
                bins[j] = np.searchsorted(self.edges[j], np.nan_to_num(x[:, j].astype(np.float32)), side="right").astype(np.uint8)
        b = np.stack([bins[j] for j in used])
        depth, trees = int(np.log2(self.leaf.shape[1])), len(self.feature)
        # a row a node, a column a tree
        f, cut, leaf = np.searchsorted(used, self.feature).T, np.minimum(self.cut, 255).astype(np.uint8).T[..., None], self.leaf.ravel()
        base = (np.arange(trees) * self.leaf.shape[1])[:, None]
        for i in range(0, len(x), 1024):
            part = np.ascontiguousarray(b[:, i : i + 1024])
            at, turns = np.zeros((trees, part.shape[1]), dtype=np.uint8), []
            for level in range(depth):
                # what every node of the level says, of which the turns so far, the last one first, leave one
                said = [(part.take(f[k], axis=0) > cut[k]).view(np.uint8) for k in range((1 << level) - 1, (2 << level) - 1)]
                for turn in reversed(turns):
                    said = [l ^ ((l ^ r) & turn) for l, r in zip(said[::2], said[1::2], strict=True)]
                turns.append(said[0])
                at = at << 1 | said[0]
            out[i : i + 1024] += leaf.take(at + base).sum(axis=0)
        return out

    def proba(self, x: np.ndarray, bins: dict[int, np.ndarray] | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x, bins)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 5, rate: float = 0.15, bins: int = 48, ridge: float = 2.0, share: float = 0.35, seed: int = 0) -> Trees:
    """Trees for labels 0/1. Each tree sees a random share of the rows; a node without a gain keeps its rows together."""
    rng = np.random.default_rng(seed)
    x = np.nan_to_num(x.astype(np.float32))
    weight = np.ones(len(y)) if weight is None else weight
    edges = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
        edges.append(q.astype(np.float32))
    p = float(np.clip(np.average(y, weights=weight) if len(y) and weight.sum() > 0 else 0.5, 1e-3, 1 - 1e-3))
    model = Trees(edges, np.zeros((0, (1 << depth) - 1), int), np.zeros((0, (1 << depth) - 1), int), np.zeros((0, 1 << depth)), float(np.log(p / (1 - p))))
    if len(y) < 20 or len(np.unique(y)) < 2:
        return model
    b = model.binned(x)
    score = np.full(len(y), model.base)
    features, cuts, leaves = [], [], []
    width = bins + 1
    wide = b.astype(np.int32) + (np.arange(x.shape[1]) * width).astype(np.int32)
    for _ in range(trees):
        rows = np.flatnonzero((rng.random(len(y)) < share) & (weight > 0))
        guess = 1 / (1 + np.exp(-score))
        g, h = weight * (guess - y), weight * guess * (1 - guess)
        gr, hr, br = g[rows], h[rows], b[rows]
        node = np.zeros(len(rows), dtype=np.int64)
        f, c = np.zeros((1 << depth) - 1, int), np.full((1 << depth) - 1, 255)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            at = node - first
            slot = (wide[rows] + (at * (x.shape[1] * width))[:, None]).ravel()
            shape = (count, x.shape[1], width)
            gs = np.bincount(slot, weights=np.repeat(gr, x.shape[1]), minlength=np.prod(shape)).reshape(shape).cumsum(axis=2)
            hs = np.bincount(slot, weights=np.repeat(hr, x.shape[1]), minlength=np.prod(shape)).reshape(shape).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
            gain[(hs < 1) | (ht - hs < 1)] = -np.inf
            where, gains = gain.argmax(axis=2), gain.max(axis=2)
            best = gains.argmax(axis=1)
            good = gains[np.arange(count), best] > 1e-6
            f[first : first + count] = np.where(good, best, 0)
            c[first : first + count] = np.where(good, where[np.arange(count), best], 255)
            node = 2 * node + 1 + (br[np.arange(len(rows)), f[node]] > c[node])
        end = node - ((1 << depth) - 1)
        leaf = -rate * np.bincount(end, weights=gr, minlength=1 << depth) / (np.bincount(end, weights=hr, minlength=1 << depth) + ridge)
        features.append(f)
        cuts.append(c)
        leaves.append(leaf)
        full = np.zeros(len(y), dtype=np.int64)
        for _ in range(depth):
            full = 2 * full + 1 + (b[np.arange(len(y)), f[full]] > c[full])
        score += leaf[full - ((1 << depth) - 1)]
    return Trees(edges, np.array(features), np.array(cuts), np.array(leaves), model.base)
