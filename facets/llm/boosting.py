"""Small gradient-boosted models on binned features, fitted on the driver from
a bounded sample and applied to arrays of rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each column ascending inner edges, at most ``bins - 1``."""
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(col, cuts)) if len(col) else np.zeros(0) for col in x.T]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin number of each value: how many edges lie below it."""
    return np.stack([np.searchsorted(e, col, "left") for col, e in zip(x.T, edges, strict=True)], axis=1) if len(edges) else np.zeros((len(x), 0), int)


def _start(y: np.ndarray) -> float:
    rate = (y.sum() + 0.5) / (len(y) + 1)
    return float(np.log(rate / (1 - rate)))


def _gain(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    return g * g / (h + penalty)


@dataclass
class Trees:
    """Boosted trees over all features. A tree of depth d has 2**d - 1 tests
    in heap order (feature, bin: go right if the row's bin is larger) and
    2**d leaves."""

    edges: list[np.ndarray]
    start: float
    depth: int
    tests: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for (feature, cut), leaf in zip(self.tests, self.leaves, strict=True):
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            total += leaf[at - (2 ** self.depth - 1)]
        return sigmoid(total)


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
              penalty: float = 2.0) -> Trees:
    """Logistic gradient boosting: each tree is grown level by level from
    histograms of gradients; the best cut of a node has the largest gain."""
    model = Trees(bin_edges(x, bins), _start(y), depth)
    b = to_bins(x, model.edges)
    total = np.full(len(y), model.start)
    for _ in range(rounds):
        p = sigmoid(total)
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2 ** depth - 1, int), np.full(2 ** depth - 1, bins)
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-9)
            for f in range(x.shape[1]):
                at = (node - first) * bins + b[:, f]
                gs = np.bincount(at, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(at, h, width * bins).reshape(width, bins).cumsum(1)
                gain = (_gain(gs, hs, penalty) + _gain(gs[:, -1:] - gs, hs[:, -1:] - hs, penalty)
                        - _gain(gs[:, -1:], hs[:, -1:], penalty))
                top = gain.argmax(1)
                won = gain[np.arange(width), top] > best
                best[won] = gain[np.arange(width), top][won]
                feature[first:first + width][won], cut[first:first + width][won] = f, top[won]
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
        at = node - (2 ** depth - 1)
        leaf = rate * np.bincount(at, g, 2 ** depth) / (np.bincount(at, h, 2 ** depth) + penalty)
        model.tests.append((feature, cut))
        model.leaves.append(leaf)
        total += leaf[at]
    return model


@dataclass
class Additive:
    """A generalised additive model with pairwise interactions: one lookup
    table for each feature, and one grid of coarser bins for each chosen pair."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    start: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        total = np.full(len(x), self.start)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        if self.pairs:
            c = to_bins(x, self.coarse)
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                total += grid[c[:, i], c[:, j]]
        return sigmoid(total)


def _stump(g: np.ndarray, h: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Leaf value for each bin of a shallow tree on one feature, grown by its
    best cuts, from sums of gradients by bin."""
    ranges = [(0, len(g))]
    while len(ranges) < leaves:
        best, pick = 1e-9, None
        for n, (a, z) in enumerate(ranges):
            if z - a < 2:
                continue
            gs, hs = g[a:z].cumsum(), h[a:z].cumsum()
            gain = _gain(gs, hs, penalty) + _gain(gs[-1] - gs, hs[-1] - hs, penalty) - _gain(gs[-1], hs[-1], penalty)
            k = int(gain[:-1].argmax())
            if gain[k] > best:
                best, pick = gain[k], (n, a + k + 1)
        if pick is None:
            break
        n, middle = pick
        a, z = ranges[n]
        ranges[n:n + 1] = [(a, middle), (middle, z)]
    out = np.zeros(len(g))
    for a, z in ranges:
        out[a:z] = g[a:z].sum() / (h[a:z].sum() + penalty)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """A depth-two tree on a pair of features: one cut of the first, then a cut
    of the second on each side. Returns the cells' values and the gain."""
    best, out = 0.0, np.zeros_like(g)
    base = _gain(g.sum(), h.sum(), penalty)
    for cut in range(1, g.shape[0]):
        values, gain = np.zeros_like(g), 0.0
        for a, z in ((0, cut), (cut, g.shape[0])):
            gs, hs = g[a:z].sum(0), h[a:z].sum(0)
            values[a:z] = _stump(gs, hs, 2, penalty)
            for v in np.unique(values[a]):
                part = values[a] == v
                gain += _gain(gs[part].sum(), hs[part].sum(), penalty)
        if gain - base > best:
            best, out = gain - base, values
    return out, best


def fit_additive(x: np.ndarray, y: np.ndarray, cycles: int = 80, rate: float = 0.15, bins: int = 64, pairs: int = 6,
                 pair_cycles: int = 30, pair_bins: int = 8, leaves: int = 4, penalty: float = 2.0) -> Additive:
    """Cyclic boosting: in every cycle each feature in turn gets a shallow tree
    fitted to what the others leave over, added to its table. Then the pairs
    with the largest gain on the remainder are boosted in the same way."""
    model = Additive(bin_edges(x, bins), bin_edges(x, pair_bins), _start(y), [])
    b, c = to_bins(x, model.edges), to_bins(x, model.coarse)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(total)
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _stump(np.bincount(b[:, j], g, len(table)), np.bincount(b[:, j], h, len(table)), leaves, penalty)
            table += step
            total += step[b[:, j]]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        at = c[:, i] * shape[1] + c[:, j]
        g, h = slopes()
        size = shape[0] * shape[1]
        return at, np.bincount(at, g, size).reshape(shape), np.bincount(at, h, size).reshape(shape)

    ranked = sorted(((_grid_tree(*grids(i, j)[1:], penalty)[1], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    for gain, i, j in ranked[:pairs]:
        if gain > 0:
            model.pairs.append((i, j))
            model.grids.append(np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)))
    for _ in range(pair_cycles if model.pairs else 0):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            at, g, h = grids(i, j)
            step = rate * _grid_tree(g, h, penalty)[0]
            grid += step
            total += step.ravel()[at]
    return model
