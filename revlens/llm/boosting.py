"""Boosted trees on binned features, for the small fits that run on a bounded sample.

Both learners work on histograms: features are cut into bins once, a split is searched
in sums of gradients and curvatures per bin. The result is arrays that a task can
apply to whole batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_DAMP = 1.0


def edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cut points at quantiles of a sample; equal values share a bin."""
    if not len(values):
        return np.empty(0)
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """``edges``, but between all values where they are few, so that rare ones stand apart."""
    distinct = np.unique(values)
    return distinct[1:] if len(distinct) <= bins else edges(values, bins)


def borders_of_counts(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """``borders`` of values that occur so often each; quantiles are values that occur."""
    order = np.argsort(values)
    values, reached = values[order], np.cumsum(counts[order])
    if len(values) <= bins:
        return values[1:]
    at = np.searchsorted(reached, reached[-1] * np.arange(1, bins) / bins)
    return np.unique(values[at])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def start(y: np.ndarray) -> float:
    """Log odds of the label, finite for one class and 0 for no rows."""
    p = (y.sum() + 1) / (len(y) + 2)
    return float(np.log(p / (1 - p)))


def _gain(g, h):
    return g * g / (h + _DAMP)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain of the best split of a row of bins, and the first bin of its right side."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def steps(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """A tree over one row of bins as the value of each bin."""
    gain, cut = best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + _DAMP))
    return np.concatenate([steps(g[:cut], h[:cut], depth - 1), steps(g[cut:], h[cut:], depth - 1)])


@dataclass
class Additive:
    """A table per feature and per chosen pair of features; a score is the sum of entries."""

    cuts: list[np.ndarray]
    base: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        coarse = {
            j: np.searchsorted(self.pair_cuts[j], x[:, j], side="right") for ab in self.pairs for j in ab
        }
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return sigmoid(total)


def fit_additive(
    x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, rate: float = 0.1,
    pairs: int = 4, pair_bins: int = 8, pair_rounds: int = 40,
) -> Additive:
    """Features take turns: each round adds a tree of depth 2 over one feature's bins to its
    table. The pairs that explain most of what is left then take turns likewise."""
    n, width = x.shape
    cuts = [edges(x[:, j], bins) for j in range(width)]
    model = Additive(cuts, start(y))
    model.tables = [np.zeros(len(c) + 1) for c in cuts]
    model.pair_cuts = [edges(x[:, j], pair_bins) for j in range(width)]
    if not n or y.min() == y.max():
        return model
    binned = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    score = np.full(n, model.base)
    for _ in range(rounds):
        for j, where in enumerate(binned):
            p = sigmoid(score)
            size = len(cuts[j]) + 1
            g = np.bincount(where, y - p, size)
            h = np.bincount(where, p * (1 - p), size)
            step = rate * steps(g, h, 2)
            model.tables[j] += step
            score += step[where]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]
    p = sigmoid(score)
    gains = []
    for a in range(width):
        for b in range(a + 1, width):
            g, h = _cells(coarse, sizes, a, b, y - p, p * (1 - p))
            gains.append((float(_gain(g, h).sum()), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:pairs]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            p = sigmoid(score)
            g, h = _cells(coarse, sizes, a, b, y - p, p * (1 - p))
            _, cut = best_cut(g.sum(1), h.sum(1))
            step = np.empty_like(table)
            for side in (slice(0, cut), slice(cut, None)):
                step[side] = rate * steps(g[side].sum(0), h[side].sum(0), 1)
            table += step
            score += step[coarse[a], coarse[b]]
    return model


def _cells(coarse, sizes, a, b, g, h):
    cell, shape = coarse[a] * sizes[b] + coarse[b], (sizes[a], sizes[b])
    count = sizes[a] * sizes[b]
    return np.bincount(cell, g, count).reshape(shape), np.bincount(cell, h, count).reshape(shape)


@dataclass
class Trees:
    """Complete trees of one depth: feature and cut of every inner node, value of every leaf."""

    base: float
    depth: int
    rate: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] >= cut[node])
            total += self.rate * value[node - (2**self.depth - 1)]
        return sigmoid(total)


#: Bins of a feature.
BINS = 32


def fit_trees(
    x: np.ndarray, y: np.ndarray, depth: int = 3, rounds: int = 60, rate: float = 0.2, bins: int = BINS,
    weight: np.ndarray | None = None, cuts: list[np.ndarray] | None = None,
) -> Trees:
    """Gradient boosting with second-order leaf values. A row counts ``weight`` times; ``cuts`` are
    the borders of the bins, of the rows' own values by default."""
    weight = np.ones(len(y)) if weight is None else weight
    p = (weight @ y + 1) / (weight.sum() + 2)
    model = Trees(float(np.log(p / (1 - p))), depth, rate)
    if not len(y) or y.min() == y.max():
        return model
    cuts = [borders(x[:, j], bins) for j in range(x.shape[1])] if cuts is None else cuts
    binned = np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], 1)
    score = np.full(len(y), model.base)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = sigmoid(score)
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                here = np.flatnonzero(node == at)
                best = (1e-9, 0, 0)
                for j, c in enumerate(cuts):
                    if len(here) and len(c):
                        sums = [np.bincount(binned[here, j], v[here], len(c) + 1) for v in (g, h)]
                        gain, k = best_cut(*sums)
                        best = max(best, (gain, j, k))
                if best[2]:
                    feature[at], cut[at] = best[1], cuts[best[1]][best[2] - 1]
            inside = node >= 2**level - 1
            node = np.where(inside, 2 * node + 1 + (x[np.arange(len(y)), feature[node]] >= cut[node]), node)
        leaf = node - inner
        value = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + _DAMP)
        model.trees.append((feature, cut, value))
        score += rate * value[leaf]
    return model
