"""A small gradient-boosted classifier: depth-limited trees on logistic loss, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: a feature and a threshold for each inner node, a value for each leaf."""

    bias: float
    feature: np.ndarray  # trees x (2**depth - 1)
    limit: np.ndarray
    leaf: np.ndarray  # trees x 2**depth

    def probability(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1]))
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - (len(f))]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 24, ridge: float = 1.0) -> Trees:
    """Newton boosting; splits are searched over at most ``bins`` quantiles of each feature."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[:-1])) for j in range(x.shape[1])]
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(base / (1 - base)))
    total = np.full(len(y), bias)
    inner = 2**depth - 1
    out = Trees(bias, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    below = [[x[:, j] <= e for e in edges[j]] for j in range(x.shape[1])]
    for k in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            here = node == at
            gs, hs = g[here].sum(), h[here].sum()
            best = 1e-6
            if here.any():
                for j in range(x.shape[1]):
                    for e, left in zip(edges[j], below[j], strict=True):
                        m = here & left
                        gl, hl = g[m].sum(), h[m].sum()
                        gain = gl * gl / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs * gs / (hs + ridge)
                        if gain > best:
                            best, out.feature[k, at], out.limit[k, at] = gain, j, e
            right = x[:, out.feature[k, at]] > out.limit[k, at]
            node = np.where(here, 2 * node + 1 + right, node)
        leaf = node - inner
        for v in range(inner + 1):
            m = leaf == v
            out.leaf[k, v] = rate * g[m].sum() / (h[m].sum() + ridge)
        total += out.leaf[k, leaf]
    return out


@dataclass
class Calibration:
    """A non-decreasing step function from scores to probabilities."""

    steps: np.ndarray  # least score of each step
    values: np.ndarray

    def __call__(self, p: np.ndarray) -> np.ndarray:
        return self.values[np.maximum(np.searchsorted(self.steps, p, side="right") - 1, 0)]


def isotonic(p: np.ndarray, y: np.ndarray) -> Calibration:
    """Isotonic regression of ``y`` on ``p`` by pooling adjacent violators; a step of n scores with h hits stands for (h + 1/2) / (n + 1)."""
    blocks: list[list[float]] = []  # least score, hits, number
    for score in np.unique(p):
        here = y[p == score]
        blocks.append([float(score), float(here.sum()), float(len(here))])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, hits, number = blocks.pop()
            blocks[-1][1] += hits
            blocks[-1][2] += number
    rate = np.array([(h + 0.5) / (n + 1) for _, h, n in blocks])
    return Calibration(np.array([b[0] for b in blocks]), np.maximum.accumulate(rate))
