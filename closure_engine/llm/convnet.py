"""A small character convolutional network for yes/no labels, in numpy."""

from __future__ import annotations

import copy
from collections.abc import Callable

import numpy as np

#: Code 0: no character; 1: outside of printable ASCII; the others: printable ASCII.
N_CODES = 97


def codes(text: str) -> list[int]:
    return [c - 30 if 32 <= c < 127 else 1 for c in map(ord, text)]


class CharNet:
    """Character vectors, one convolution, the maximum over each region, one hidden layer, a logit.

    Regions are fixed column ranges of the input: what stands before a
    candidate, the candidate, what follows; so a filter's answer says where it
    was found.  Probabilities are calibrated by Platt scaling on held-out rows.
    """

    def __init__(self, regions: tuple[int, ...], width: int = 5, dim: int = 8, filters: int = 24, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.width, self.bounds = width, np.cumsum((0, *regions))
        n = len(regions) * filters
        self.w = {
            "chars": r.normal(0, 0.3, (N_CODES, dim)), "conv": r.normal(0, (width * dim) ** -0.5, (width * dim, filters)),
            "conv_b": np.zeros(filters), "hidden": r.normal(0, n ** -0.5, (n, hidden)), "hidden_b": np.zeros(hidden),
            "out": r.normal(0, hidden ** -0.5, hidden), "out_b": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.scale, self.shift = 1.0, 0.0

    def _tables(self) -> np.ndarray:
        """What a character adds to each filter's answer, by its place in the filter: (width, codes, filters)."""
        return self.w["chars"] @ self.w["conv"].reshape(self.width, -1, self.w["conv"].shape[1])

    def _answers(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The padded codes, and each filter's answer at each column without its shift: (rows, columns, filters)."""
        half, cols = self.width // 2, x.shape[1]
        padded = np.pad(x.astype(np.intp), ((0, 0), (half, half)))
        tables = self._tables()
        maps = tables[0].take(padded[:, :cols], 0)
        for j in range(1, self.width):
            maps += tables[j].take(padded[:, j:j + cols], 0)
        return padded, maps

    def _above(self, top: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pooled, inner, logits) from the largest answers of the regions."""
        w = self.w
        pooled = np.maximum(np.concatenate([t + w["conv_b"] for t in top], 1), 0)
        inner = np.maximum(pooled @ w["hidden"] + w["hidden_b"], 0)
        return pooled, inner, inner @ w["out"] + w["out_b"][0]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        maps = self._answers(x)[1]
        return self._above([maps[:, a:b].max(1) for a, b in zip(self.bounds[:-1], self.bounds[1:])])

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, seed: int = 7) -> CharNet:
        r, moments, step = np.random.default_rng(seed), ({}, {}), 0
        for _ in range(epochs):
            step = self._epoch(x, y, r, moments, step)
        return self

    def _epoch(self, x: np.ndarray, y: np.ndarray, r: np.random.Generator, moments: tuple[dict, dict], step: int, batch: int = 128, rate: float = 4e-3) -> int:
        """Adam's steps over all rows once; ``moments`` and the number of steps go on."""
        m, v = moments
        order = r.permutation(len(x))
        for a in range(0, len(x), batch):
            at, step = order[a:a + batch], step + 1
            for k, g in self._gradients(x[at], y[at]).items():
                m[k] = 0.9 * m.get(k, 0.0) + 0.1 * g
                v[k] = 0.999 * v.get(k, 0.0) + 0.001 * g * g
                self.w[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return step

    def fit_blocks(self, summed: Callable, rows: Callable, epochs: int = 12, seed: int = 7) -> CharNet:
        """Fits on blocks of rows: in each epoch every block takes its own steps over its rows, then the nets and Adam's moments are averaged by rows.

        ``summed(vector)`` adds up ``vector(block, *buffers)`` over the blocks, ``rows(*buffers)`` gives a block's (x, y).
        """
        names = sorted(self.w)
        moments = tuple({k: np.zeros_like(self.w[k]) for k in names} for _ in range(2))
        steps = 0.0

        for epoch in range(epochs):
            net, start = copy.deepcopy(self), int(steps)

            def vector(block: int, *buffers: bytes) -> np.ndarray:
                x, y = rows(*buffers)
                own, kept = copy.deepcopy(net), copy.deepcopy(moments)
                taken = own._epoch(x, y, np.random.default_rng((seed, block, epoch)), kept, start) - start
                return len(x) * np.concatenate([[1.0, taken], *(part[k].ravel().astype(float) for part in (own.w, *kept) for k in names)])

            total = summed(vector)
            total, at = total / total[0], 2
            steps += total[1]
            for part in (self.w, *moments):
                for k in names:
                    n = self.w[k].size
                    part[k] = total[at:at + n].reshape(self.w[k].shape).astype(np.float32)
                    at += n
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, n, filters = self.w, len(x), self.w["conv"].shape[1]
        padded, maps = self._answers(x)
        where = [maps[:, a:b].argmax(1) + a for a, b in zip(self.bounds[:-1], self.bounds[1:])]
        pooled, inner, logit = self._above([np.take_along_axis(maps, at[:, None], 1)[:, 0] for at in where])
        d = ((1 / (1 + np.exp(-logit)) - y) / n).astype(np.float32)
        out = {"out": inner.T @ d, "out_b": np.array([d.sum()])}
        d_inner = d[:, None] * w["out"] * (inner > 0)
        out |= {"hidden": pooled.T @ d_inner, "hidden_b": d_inner.sum(0)}
        d_pooled = (d_inner @ w["hidden"].T) * (pooled > 0)
        rows, column = np.arange(n)[:, None], np.arange(filters)
        at = np.stack(where)  # only the largest answer of a region has a gradient
        g = d_pooled.reshape(n, len(where), filters).transpose(1, 0, 2)
        tables = np.stack([np.bincount((padded[rows, at + j] * filters + column).ravel(), g.ravel(), N_CODES * filters)
                           for j in range(self.width)]).reshape(self.width, N_CODES, filters).astype(np.float32)
        conv = w["conv"].reshape(self.width, -1, filters)
        return out | {"conv": (w["chars"].T @ tables).reshape(-1, filters), "conv_b": g.sum((0, 1)),
                      "chars": (tables @ conv.transpose(0, 2, 1)).sum(0)}

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[a:a + 512])[-1] for a in range(0, len(x), 512)] or [np.zeros(0)]).astype(float)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> CharNet:
        z = self.logits(x)
        return self.calibrate_by(lambda a, b: newton_sums(z, y, a, b))

    def calibrate_by(self, sums: Callable[[float, float], np.ndarray], steps: int = 30) -> CharNet:
        """``sums(a, b)``: what ``newton_sums`` gives for all held-out rows."""
        a, b = 1.0, 0.0
        for _ in range(steps):  # Newton's method, with a weak pull to the uncalibrated answer
            ga, gb, haa, hab, hbb = sums(a, b)
            g = np.array([ga + 0.1 * (a - 1), gb + 0.1 * b])
            h = np.array([[haa + 0.1, hab], [hab, hbb + 0.1]])
            before = a, b
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
            a = max(a, 1e-3)
            if max(abs(a - before[0]), abs(b - before[1])) < 1e-12:
                break
        self.scale, self.shift = float(a), float(b)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of the label 1."""
        return self.probability(self.logits(x))

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))


def newton_sums(z: np.ndarray, y: np.ndarray, a: float, b: float) -> np.ndarray:
    """Gradient and second derivatives of the logistic loss of ``a * z + b``."""
    p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
    q = p * (1 - p)
    return np.array([((p - y) * z).sum(), (p - y).sum(), (q * z * z).sum(), (q * z).sum(), q.sum()])
