"""Isolation forest (Liu, Ting and Zhou 2008) on NumPy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def mean_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1 at a leaf), cut, left child (right is next), depth plus the leaf's mean path."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    sample: int

    @classmethod
    def fit(cls, x: np.ndarray, trees: int = 200, sample: int = 256, seed: int = 42) -> Forest:
        if len(x) < 2:
            raise ValueError("an isolation forest needs two rows at least")
        rng = np.random.default_rng(seed)
        sample = min(sample, len(x))
        most = int(np.ceil(np.log2(sample)))
        return cls([cls._grown(x[rng.choice(len(x), sample, replace=False)], most, rng) for _ in range(trees)], sample)

    @staticmethod
    def _grown(x: np.ndarray, most: int, rng: np.random.Generator):
        feature, cut, left, path = [], [], [], []

        def new() -> int:
            for held, v in ((feature, -1), (cut, 0.0), (left, 0), (path, 0.0)):
                held.append(v)
            return len(feature) - 1

        todo = [(new(), np.arange(len(x)), 0)]
        while todo:
            node, rows, depth = todo.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth >= most or len(rows) < 2 or not len(varied):
                path[node] = depth + float(mean_path(len(rows)))
                continue
            f = int(rng.choice(varied))
            at = rng.uniform(low[f], high[f])
            feature[node], cut[node] = f, at
            left[node] = new()
            new()
            below = x[rows, f] < at
            todo += [(left[node], rows[below], depth + 1), (left[node] + 1, rows[~below], depth + 1)]
        return np.array(feature), np.array(cut), np.array(left), np.array(path)

    def decision(self, x: np.ndarray) -> np.ndarray:
        """0.5 less the anomaly score: the lower, the more anomalous."""
        total = np.zeros(len(x))
        for feature, cut, left, path in self.trees:
            node = np.zeros(len(x), np.int64)
            while (inner := feature[node] >= 0).any():
                rows = np.flatnonzero(inner)
                at = node[rows]
                node[rows] = left[at] + (x[rows, feature[at]] >= cut[at])
            total += path[node]
        return 0.5 - 2.0 ** (-total / len(self.trees) / float(mean_path(self.sample)))
