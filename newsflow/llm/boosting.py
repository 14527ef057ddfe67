"""Small boosted models over a bounded labelled sample (numpy, driver side).

``rows`` of the sample is the documented bound; the fitted models are a few
kilobytes and travel in the task closure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Interior quantile edges of each column (fewer where values tie)."""
    q = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], q)) if len(x) else np.zeros(0) for j in range(x.shape[1])]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.int64)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="left")
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def prior(y: np.ndarray) -> float:
    p = (y.sum() + 0.5) / (len(y) + 1)
    return float(np.log(p / (1 - p)))


@dataclass
class Gbt:
    """Gradient-boosted trees of one depth on binned features."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray      # a row goes right when its bin is above the cut
    leaf: np.ndarray     # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        z = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:
                node = 2 * node + 1 + (b[rows, f[node]] > c[node])
            z += leaf[node - inner]
        return z


def fit_gbt(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15,
            bins: int = 32, l2: float = 2.0, least: int = 8) -> Gbt:
    """Logistic loss, Newton leaves, exact best split of each node's histograms."""
    edges = bin_edges(x, bins)
    b = to_bins(x, edges)
    n, k = b.shape
    inner = 2 ** depth - 1
    feature = np.zeros((trees, inner), np.int64)
    cut = np.full((trees, inner), bins, np.int64)
    leaf = np.zeros((trees, inner + 1))
    z = np.full(n, prior(y))
    cell = b + np.arange(k) * bins
    for t in range(trees):
        p = sigmoid(z)
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (k * bins) + cell).ravel()
            size = width * k * bins
            sums = [np.bincount(at, np.repeat(v, k), size).reshape(width, k, bins).cumsum(2)
                    for v in (g, h, np.ones(n))]
            (gl, hl, nl), (ga, ha, na) = sums, [s[:, :, -1:] for s in sums]
            gain = (gl ** 2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga ** 2 / (ha + l2))
            gain[(nl < least) | (na - nl < least)] = 0
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            ok = flat[np.arange(width), best] > 1e-9
            feature[t, first:first + width] = best // bins
            cut[t, first:first + width] = np.where(ok, best % bins, bins)
            node = 2 * node + 1 + (b[np.arange(n), feature[t, node]] > cut[t, node])
        at = node - inner
        leaf[t] = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + l2)
        z += leaf[t, at]
    return Gbt(edges, prior(y), feature, cut, leaf)


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (knots, values), to be read with ``np.interp``."""
    if not len(score):
        return np.zeros(1), np.full(1, 0.5)
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        blocks.append([float(v), 1.0, float(s), float(s)])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            v2, n2, _, hi = blocks.pop()
            blocks[-1][0] += v2
            blocks[-1][1] += n2
            blocks[-1][3] = hi
    knots = np.array([k for b in blocks for k in (b[2], b[3])])
    values = np.repeat([(b[0] + 0.02) / (b[1] + 0.04) for b in blocks], 2)
    return knots, values


@dataclass
class Gam:
    """Additive lookup tables: one per feature, one per chosen pair."""

    edges: list[np.ndarray]
    base: float
    tables: np.ndarray            # features x bins
    pairs: list[tuple[int, int]]
    coarse: int
    pair_tables: np.ndarray       # pairs x coarse x coarse

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        z = self.base + self.tables[np.arange(b.shape[1]), b].sum(1)
        c = coarse_bins(b, self.tables.shape[1], self.coarse)
        for (i, j), t in zip(self.pairs, self.pair_tables):
            z += t[c[:, i], c[:, j]]
        return z


def coarse_bins(b: np.ndarray, bins: int, coarse: int) -> np.ndarray:
    return b * coarse // bins


def _shallow_1d(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int, l2: float, least: int) -> np.ndarray:
    """Best-first splits of one feature's bins; the value of each bin."""
    cuts = [0, len(g)]
    cg, ch, cn = (np.concatenate([[0], v.cumsum()]) for v in (g, h, n))

    def best(a: int, b: int) -> tuple[float, int]:
        s = np.arange(a + 1, b)
        if not len(s):
            return 0.0, -1
        gl, hl, nl = cg[s] - cg[a], ch[s] - ch[a], cn[s] - cn[a]
        gr, hr, nr = cg[b] - cg[s], ch[b] - ch[s], cn[b] - cn[s]
        gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - (gl + gr) ** 2 / (hl + hr + l2)
        gain[(nl < least) | (nr < least)] = 0
        k = int(gain.argmax())
        return float(gain[k]), int(s[k])

    while len(cuts) <= leaves:
        found = max((best(a, b) for a, b in zip(cuts, cuts[1:])), default=(0.0, -1))
        if found[0] <= 1e-9:
            break
        cuts = sorted([*cuts, found[1]])
    out = np.zeros(len(g))
    if len(cuts) > 2:
        for a, b in zip(cuts, cuts[1:]):
            out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 32,
            coarse: int = 8, n_pairs: int = 6, pair_rounds: int = 60, l2: float = 2.0, least: int = 8) -> Gam:
    """Cyclic boosting: every round visits each feature once with a shallow tree of
    its own; then the pairs with the largest remaining gain are boosted alike."""
    edges = bin_edges(x, bins)
    b = to_bins(x, edges)
    n, k = b.shape
    tables = np.zeros((k, bins))
    z = np.full(n, prior(y))
    for _ in range(rounds):
        for j in range(k):
            p = sigmoid(z)
            step = rate * _shallow_1d(np.bincount(b[:, j], y - p, bins), np.bincount(b[:, j], p * (1 - p), bins),
                                      np.bincount(b[:, j], None, bins), 3, l2, least)
            tables[j] += step
            z += step[b[:, j]]
    c = coarse_bins(b, bins, coarse)

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(z)
        at = c[:, i] * coarse + c[:, j]
        return (np.bincount(at, y - p, coarse ** 2).reshape(coarse, coarse),
                np.bincount(at, p * (1 - p), coarse ** 2).reshape(coarse, coarse))

    def quadrants(i: int, j: int) -> tuple[float, np.ndarray]:
        """The best cross of one cut on each feature: gain and the value of each cell."""
        g, h = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in cells(i, j))

        def four(v: np.ndarray) -> list[np.ndarray]:
            top, left, all_ = v[1:-1, -1:], v[-1:, 1:-1], v[-1, -1]
            tl = v[1:-1, 1:-1]
            return [tl, top - tl, left - tl, all_ - top - left + tl]

        gq, hq = four(g), four(h)
        gain = sum(a ** 2 / (e + l2) for a, e in zip(gq, hq))
        at = int(gain.argmax())
        r, s = divmod(at, coarse - 1)
        val = [a[r, s] / (e[r, s] + l2) for a, e in zip(gq, hq)]
        out = np.empty((coarse, coarse))
        out[:r + 1, :s + 1], out[:r + 1, s + 1:], out[r + 1:, :s + 1], out[r + 1:, s + 1:] = val
        return float(gain.ravel()[at]), out

    ranked = sorted(((quadrants(i, j)[0], i, j) for i in range(k) for j in range(i + 1, k)), reverse=True)
    pairs = [(i, j) for gain, i, j in ranked[:n_pairs] if gain > 0]
    pair_tables = np.zeros((len(pairs), coarse, coarse))
    for _ in range(pair_rounds):
        for q, (i, j) in enumerate(pairs):
            step = rate * quadrants(i, j)[1]
            pair_tables[q] += step
            z += step[c[:, i], c[:, j]]
    return Gam(edges, prior(y), tables, pairs, coarse, pair_tables)
