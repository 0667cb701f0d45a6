"""Gradient-boosted trees on dense features with a logistic loss, and isotonic calibration. Plain numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    feature: np.ndarray  # of each inner node, in level order; -1: everything goes left
    cut: np.ndarray
    value: np.ndarray  # of each leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(int(np.log2(len(self.value)))):
            f = self.feature[at]
            at = 2 * at + 1 + ((f >= 0) & (x[rows, f] > self.cut[at]))
        return self.value[at - len(self.feature)]


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.predict(x)
        return out


def boost(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, ridge: float = 2.0
) -> Boosted:
    """Fits on quantile bins; each leaf takes a Newton step."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    margin, out, inner = np.full(n, base), [], 2**depth - 1
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = y - prob, prob * (1 - prob)
        feature, cut, at = np.full(inner, -1), np.zeros(inner), np.zeros(n, dtype=np.int64)
        for node in range(inner):
            mine = np.flatnonzero(at == node)
            best = 1e-6
            if len(mine) >= 10:
                total_g, total_h = grad[mine].sum(), hess[mine].sum()
                for f in range(width):
                    if not len(cuts[f]):
                        continue
                    g = np.cumsum(np.bincount(binned[mine, f], grad[mine], len(cuts[f]) + 1))[:-1]
                    h = np.cumsum(np.bincount(binned[mine, f], hess[mine], len(cuts[f]) + 1))[:-1]
                    gain = g**2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g**2 / (total_h + ridge)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], f, cuts[f][k]
            right = (x[mine, feature[node]] > cut[node]) if feature[node] >= 0 else np.zeros(len(mine), dtype=bool)
            at[mine] = 2 * node + 1 + right
        leaf = at - inner
        g, h = np.bincount(leaf, grad, 2**depth), np.bincount(leaf, hess, 2**depth)
        tree = Tree(feature, cut, rate * g / (h + ridge))
        margin += tree.value[leaf]
        out.append(tree)
    return Boosted(base, out)


@dataclass
class Isotonic:
    x: np.ndarray
    y: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.x, self.y)


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Isotonic:
    """The non-decreasing step function nearest to y, by pooling neighbours; linear between pools."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # mean, weight, least and greatest margin
    for m, v, w in zip(margin[order].tolist(), y[order].tolist(), weight[order].tolist()):
        pools.append([v, w, m, m])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            b, a = pools.pop(), pools.pop()
            w = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2], b[3]])
    x = np.array([v for p in pools for v in (p[2], p[3])])
    return Isotonic(x, np.array([p[0] for p in pools for _ in range(2)]))
