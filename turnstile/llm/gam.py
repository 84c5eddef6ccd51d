"""A generalised additive model with pairwise interactions over binned features.

Shallow trees are boosted in cycles, one feature at a time, and added up in a lookup table per
feature; then the pairs of features that explain most of the rest get tables of their own in
the same way. A score is a sum of table entries, looked up for all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np

BINS = 48
PAIR_BINS = 8
LEAVES = 3
RATE = 0.1
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 8
MIN_HESSIAN = 2.0
SMOOTH = 1.0


@dataclass
class Gam:
    cuts: list[np.ndarray]
    bias: float
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        total = np.full(len(features), self.bias)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[k], features[:, k], side="right")]
        coarse = {k: np.searchsorted(self.pair_cuts[k], features[:, k], side="right")
                  for pair in self.pairs for k in pair}
        for (a, b), table in self.pairs.items():
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Distinct inner bin edges with about equally many values between them."""
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return (distinct[:-1] + distinct[1:]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient**2 / (hessian + SMOOTH)


def small_tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf values per bin of a tree over ordered bins, grown best split first."""
    parts = [(0, len(gradient))]

    def best(start: int, stop: int) -> tuple[float, int]:
        g, h = np.cumsum(gradient[start:stop]), np.cumsum(hessian[start:stop])
        if stop - start < 2:
            return 0.0, start
        left, right = h[:-1], h[-1] - h[:-1]
        gains = _gain(g[:-1], left) + _gain(g[-1] - g[:-1], right) - _gain(g[-1], h[-1])
        gains[(left < MIN_HESSIAN) | (right < MIN_HESSIAN)] = 0
        at = int(np.argmax(gains))
        return float(gains[at]), start + at + 1

    while len(parts) < leaves:
        found = [(*best(*part), part) for part in parts]
        gain, at, part = max(found, key=lambda f: f[0])
        if gain <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], at), (at, part[1])]
    out = np.zeros(len(gradient))
    for start, stop in parts:
        out[start:stop] = gradient[start:stop].sum() / (hessian[start:stop].sum() + SMOOTH)
    return out


def quadrants(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut on each of two features, as gain and leaf values per cell."""
    g, h = (np.cumsum(np.cumsum(x, 0), 1) for x in (gradient, hessian))
    best, values = 0.0, np.zeros_like(gradient)
    if min(gradient.shape) < 2:
        return best, values

    def four(x: np.ndarray) -> list[np.ndarray]:
        a, row, column = x[:-1, :-1], x[:-1, -1:], x[-1:, :-1]
        return [a, row - a, column - a, x[-1, -1] - row - column + a]

    gs, hs = four(g), four(h)
    gains = sum(_gain(a, b) for a, b in zip(gs, hs, strict=True)) - _gain(g[-1, -1], h[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    rows, columns = np.arange(gradient.shape[0]) > i, np.arange(gradient.shape[1]) > j
    for a, b, low, right in zip(gs, hs, (False, False, True, True), (False, True, False, True),
                                strict=True):
        values[np.ix_(rows == low, columns == right)] = a[i, j] / (b[i, j] + SMOOTH)
    return float(gains[i, j]), values


def fit(features: np.ndarray, labels: np.ndarray) -> Gam:
    """Fit on a bounded table of rows. Without rows, or with one class, the score is constant."""
    n, width = features.shape
    share = (labels.sum() + 0.5) / (n + 1)
    cuts = [quantile_cuts(features[:, k], BINS) if n else np.array([]) for k in range(width)]
    coarse_cuts = [quantile_cuts(features[:, k], PAIR_BINS) if n else np.array([])
                   for k in range(width)]
    model = Gam(cuts, float(np.log(share / (1 - share))),
                [np.zeros(len(c) + 1) for c in cuts], coarse_cuts)
    if n == 0 or labels.min() == labels.max():
        return model
    bins = [np.searchsorted(c, features[:, k], side="right") for k, c in enumerate(cuts)]
    total = np.full(n, model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * small_tree(np.bincount(bins[k], g, len(table)),
                                     np.bincount(bins[k], h, len(table)))
            table += step
            total += step[bins[k]]
    coarse = [np.searchsorted(c, features[:, k], side="right") for k, c in enumerate(coarse_cuts)]
    sizes = [len(c) + 1 for c in coarse_cuts]

    def cells(pair: tuple[int, int], g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        a, b = pair
        at, shape = coarse[a] * sizes[b] + coarse[b], (sizes[a], sizes[b])
        area = sizes[a] * sizes[b]
        return quadrants(np.bincount(at, g, area).reshape(shape),
                         np.bincount(at, h, area).reshape(shape))

    g, h = slopes()
    ranked = sorted(combinations(range(width), 2), key=lambda p: (-cells(p, g, h)[0], p))[:PAIRS]
    model.pairs = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in ranked}
    for _ in range(PAIR_ROUNDS):
        for pair, table in model.pairs.items():
            step = RATE * cells(pair, *slopes())[1]
            table += step
            total += step[coarse[pair[0]], coarse[pair[1]]]
    return model
