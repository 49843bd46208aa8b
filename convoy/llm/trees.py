"""Histogram gradient-boosted trees for a binary label, flattened into arrays.

Training works on a bounded matrix with numpy: features are cut into quantile bins, each level's splits are found from
histograms of gradients. A fitted model is five arrays for all trees together, so scoring a batch walks every row of
the batch down a tree with a few numpy operations a level. Features may be declared monotonic: a split that would
order its children against the declared direction is not taken, and children inherit bounds on their values, so the
score never moves against the direction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """``feature`` is -1 at leaves; children of node i are ``left[i]`` and ``left[i] + 1``."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


@dataclass(frozen=True)
class Settings:
    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    least: int = 20
    ridge: float = 1.0


def constant(share: float) -> Trees:
    """A model without trees, for tables that have no labels or only one."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    none = np.zeros(0, np.int64)
    return Trees(float(np.log(share / (1 - share))), none, none, np.zeros(0), none, np.zeros(0), 0)


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings(), directions=None) -> Trees:
    """``directions``: one of -1, 0, 1 for each feature; the score falls, is free, or rises with it."""
    n, width = x.shape
    if n == 0 or y.min() == y.max():
        return constant(float(y.mean()) if n else 0.5)
    directions = np.zeros(width, int) if directions is None else np.asarray(directions)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, settings.bins + 1)[1:-1])) for j in range(width)]
    bins = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    slots = settings.bins
    flat = bins + np.arange(width) * slots
    start = constant(float(y.mean())).base
    margin = np.full(n, start)
    feature, threshold, left, value, roots = [], [], [], [], []

    def new_node() -> int:
        for column, first in ((feature, -1), (threshold, 0.0), (left, 0), (value, 0.0)):
            column.append(first)
        return len(feature) - 1

    for _ in range(settings.trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        root = new_node()
        roots.append(root)
        level = [(root, np.arange(n), -np.inf, np.inf)]
        for depth in range(settings.depth + 1):
            following = []
            for node, rows, low, high in level:
                best = _best_split(flat[rows], gradient[rows], weight[rows], cuts, slots, directions, settings, low, high) if depth < settings.depth else None
                if best is None:
                    leaf = -gradient[rows].sum() / (weight[rows].sum() + settings.ridge)
                    value[node] = settings.rate * float(np.clip(leaf, low, high))
                    margin[rows] += value[node]
                    continue
                j, cut, l_value, r_value = best
                feature[node], threshold[node] = j, float(cuts[j][cut])
                child = left[node] = new_node()
                new_node()
                goes_right = bins[rows, j] > cut
                middle = (l_value + r_value) / 2
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}
                for k, part in enumerate((rows[~goes_right], rows[goes_right])):
                    following.append((child + k, part, *bounds[int(directions[j])][k]))
            level = following
    return Trees(start, np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(value), settings.depth)


def _best_split(flat, gradient, weight, cuts, slots, directions, settings, low, high):
    """(feature, cut, left value, right value) with the largest gain, or None."""
    if len(flat) < 2 * settings.least:
        return None
    width = len(cuts)
    size = width * slots
    sums = [
        np.bincount(flat.ravel(), np.repeat(v, width), size).reshape(width, slots).cumsum(1)
        for v in (gradient, weight, np.ones(len(gradient)))
    ]
    (gl, hl, nl) = (s[:, :-1] for s in sums)
    (gr, hr, nr) = (s[:, -1:] - s[:, :-1] for s in sums)
    v_left = np.clip(-gl / (hl + settings.ridge), low, high)
    v_right = np.clip(-gr / (hr + settings.ridge), low, high)

    def loss(g, h, v):
        return g * v + 0.5 * (h + settings.ridge) * v * v

    g, h = gradient.sum(), weight.sum()
    whole = loss(g, h, float(np.clip(-g / (h + settings.ridge), low, high)))
    gain = whole - loss(gl, hl, v_left) - loss(gr, hr, v_right)
    allowed = (nl >= settings.least) & (nr >= settings.least)
    allowed &= np.arange(slots - 1)[None, :] < np.array([len(c) for c in cuts])[:, None]
    allowed &= directions[:, None] * (v_right - v_left) >= 0
    gain = np.where(allowed, gain, -np.inf)
    at = int(gain.argmax())
    j, cut = divmod(at, slots - 1)
    if not gain[j, cut] > 1e-6:
        return None
    return j, cut, float(v_left[j, cut]), float(v_right[j, cut])
