"""A small gradient-boosted tree classifier in numpy; for bounded training sets on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees of fixed depth, kept as heaps: node i has children 2i + 1 and 2i + 2."""

    depth: int = 3
    rounds: int = 60
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._tree(binned, cuts, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._walk(tree, x)
        return self

    def _tree(self, binned, cuts, g, h):
        inner = 2**self.depth - 1
        feature, value = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(g), np.int64)
        for i in range(inner):
            mine = np.flatnonzero(node == i)
            best = (1e-9, 0, 0)
            if len(mine) > 1:
                total_g, total_h = g[mine].sum(), h[mine].sum()
                for f, c in enumerate(cuts):
                    b = binned[mine, f]
                    left_g = np.cumsum(np.bincount(b, g[mine], len(c) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(b, h[mine], len(c) + 1))[:-1]
                    if not len(left_g):
                        continue
                    gain = left_g**2 / (left_h + self.ridge)
                    gain += (total_g - left_g) ** 2 / (total_h - left_h + self.ridge)
                    gain -= total_g**2 / (total_h + self.ridge)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
                if best[0] > 1e-9:
                    feature[i], value[i] = best[1], cuts[best[1]][best[2]]
            goes_right = binned[mine, best[1]] > best[2] if best[0] > 1e-9 else np.zeros(len(mine), bool)
            node[mine] = 2 * i + 1 + goes_right
        leaf = node - inner
        size = 2**self.depth
        up, down = np.bincount(leaf, g, size), np.bincount(leaf, h, size)
        return feature, value, self.rate * up / (down + self.ridge)

    def _walk(self, tree, x):
        feature, value, leaves = tree
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > value[node])
        return leaves[node - len(feature)]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self._walk(tree, x)
        return 1 / (1 + np.exp(-score))


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest score above which held-out rows reach the precision; 2 if there is none."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last_of_tie = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last_of_tie)
    return float(p[order][good[-1]]) if len(good) else 2.0
