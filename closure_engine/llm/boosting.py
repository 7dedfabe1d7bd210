"""Gradient-boosted trees for yes/no labels, in numpy: binned features, logistic loss."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Threshold where no score is precise enough.
NO_THRESHOLD = 0.99


class BoostedTrees:
    """Complete binary trees of ``depth`` levels, fitted one after the other to the loss's gradients."""

    def __init__(self, rounds: int = 40, depth: int = 3, bins: int = 32, rate: float = 0.3, ridge: float = 1.0):
        self.rounds, self.depth, self.bins, self.rate, self.ridge = rounds, depth, bins, rate, ridge
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        edges = [np.unique(np.quantile(c, self.shares())) for c in x.T] if len(x) else []
        part = Part(binned(x, edges), y)
        return self.grow(edges, y.mean(), part.sums)

    def shares(self) -> np.ndarray:
        """Quantiles of a feature between which its bins lie."""
        return np.linspace(0, 1, self.bins + 1)[1:-1]

    def grow(self, edges: list[np.ndarray], mean: float, sums: Callable[[Grown], np.ndarray]) -> BoostedTrees:
        """``sums``: adds up ``Part.sums`` over the parts that the rows are in."""
        mean = np.clip(mean, 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        grown = Grown(self.start, self.depth, self.bins)
        inner = (1 << self.depth) - 1
        for _ in range(self.rounds):
            feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
            tree = (np.zeros(inner, np.int64), np.full(inner, self.bins), None)  # with bins for values
            for level in range(self.depth):
                width = 1 << level
                g, h = sums(grown.growing(tree, level)).reshape(2, len(edges), width, self.bins)
                best, base = np.full(width, 1e-9), width - 1
                split = np.full((width, 2), -1)
                leaf_g, leaf_h = (np.stack((x[0].sum(1), np.zeros(width)), 1) for x in (g, h))  # what isn't split goes left
                for f in range(len(edges)):
                    if not len(edges[f]):
                        continue
                    left_g, left_h = np.cumsum(g[f], 1), np.cumsum(h[f], 1)
                    all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                    gain = left_g ** 2 / (left_h + self.ridge) + (all_g - left_g) ** 2 / (all_h - left_h + self.ridge) - all_g ** 2 / (all_h + self.ridge)
                    gain = gain[:, :len(edges[f])]
                    at = gain.argmax(1)
                    top = gain[np.arange(width), at]
                    better = np.flatnonzero(top > best)
                    best[better], split[better, 0], split[better, 1] = top[better], f, at[better]
                    for x, left, every in ((leaf_g, left_g, all_g), (leaf_h, left_h, all_h)):
                        x[better, 0] = left[better, at[better]]
                        x[better, 1] = every[better, 0] - x[better, 0]
                for i in np.flatnonzero(split[:, 0] >= 0):
                    feature[base + i], cut[base + i] = split[i, 0], edges[split[i, 0]][split[i, 1]]
                    tree[0][base + i], tree[1][base + i] = split[i]
            value = -self.rate * leaf_g.ravel() / (leaf_h.ravel() + self.ridge)
            self.trees.append((feature, cut, value))
            grown.trees.append((tree[0], tree[1], value))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label 1."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - len(cut)]
        return 1 / (1 + np.exp(-out))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """A row of bins a feature; bin b: edges[b-1] < value <= edges[b]."""
    return np.array([np.searchsorted(e, c) for e, c in zip(edges, x.T)], np.uint8).reshape(len(edges), len(x))


class Grown:
    """The trees so far, by bins, and the one that grows."""

    def __init__(self, start: float, depth: int, bins: int):
        self.start, self.depth, self.bins, self.trees, self.tree, self.level = start, depth, bins, [], None, 0

    def growing(self, tree: tuple, level: int) -> Grown:
        self.tree, self.level = tree, level
        return self


class Part:
    """Binned rows and their labels, with their scores by the trees so far."""

    def __init__(self, bins: np.ndarray, y: np.ndarray):
        self.bins, self.y, self.score, self.seen = bins, y, None, 0

    def _places(self, tree: tuple, levels: int) -> np.ndarray:
        node, rows = np.zeros(len(self.y), np.int64), np.arange(len(self.y))
        for level in range(levels):
            at = node + (1 << level) - 1
            node = 2 * node + (self.bins[tree[0][at], rows] > tree[1][at])
        return node

    def sums(self, grown: Grown) -> np.ndarray:
        """The loss's first and second derivatives, added up by feature, place in the growing level and bin."""
        if self.score is None:
            self.score = np.full(len(self.y), grown.start)
        for tree in grown.trees[self.seen:]:
            self.score += tree[2][self._places(tree, grown.depth)]
        self.seen = len(grown.trees)
        p = 1 / (1 + np.exp(-self.score))
        node, size = self._places(grown.tree, grown.level) * grown.bins, grown.bins << grown.level
        return np.concatenate([np.bincount(node + b, w, size) for w in (p - self.y, np.maximum(p * (1 - p), 1e-6)) for b in self.bins])


def precise_threshold(score: np.ndarray, label: np.ndarray, precision: float, fallback: float = NO_THRESHOLD) -> float:
    """The lowest score from which on at least ``precision`` of the rows are labelled 1."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(label[order]) / np.arange(1, len(order) + 1)
    last = np.append(score[order][1:] < score[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(score[order][good[-1]]) if len(good) else fallback


def recall_threshold(score: np.ndarray, label: np.ndarray, recall: float, fallback: float = 0.5) -> float:
    """The highest score that still finds at least ``recall`` of the rows labelled 1."""
    held = np.sort(score[label > 0])
    return float(held[int(np.floor((1 - recall) * len(held)))]) if len(held) else fallback
