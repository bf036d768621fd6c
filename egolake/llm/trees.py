"""Gradient-boosted regression trees on binned features, and isotonic calibration, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 64


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)], axis=1).astype(np.int64)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, l2: float = 1.0, least: float = 2.0) -> dict:
    """Boost ``rounds`` complete trees of ``depth`` levels on the logistic loss.

    A node without a split of positive gain sends all rows left. One class only, or no
    rows, gives a constant model.
    """
    p = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    model = {"base": float(np.log(p / (1 - p))), "edges": bin_edges(x) if len(x) else [], "trees": [], "depth": depth}
    if len(np.unique(y)) < 2:
        return model
    b, score = binned(x, model["edges"]), np.full(len(y), model["base"])
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-score))
        g, h = prob - y, prob * (1 - prob)
        node, splits = np.zeros(len(y), np.int64), []
        for level in range(depth):
            best = np.zeros((1 << level, 3))
            best[:, 1:] = 0, BINS
            for j in range(x.shape[1]):
                cell, size = node * BINS + b[:, j], (1 << level) * BINS
                gl = np.bincount(cell, g, size).reshape(-1, BINS).cumsum(1)
                hl = np.bincount(cell, h, size).reshape(-1, BINS).cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga**2 / (ha + l2)
                gain[(hl < least) | (ha - hl < least)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(len(at)), at]
                better = top > best[:, 0] + 1e-9
                best[better] = np.stack([top, np.full(len(at), j), at + 0.0], 1)[better]
            splits.append(best[:, 1:].astype(np.int64))
            f, t = splits[-1][node].T
            node = 2 * node + (b[np.arange(len(y)), f] > t)
        n = 1 << depth
        leaf = -rate * np.bincount(node, g, n) / (np.bincount(node, h, n) + l2)
        model["trees"].append((splits, leaf))
        score += leaf[node]
    return model


def raw_score(model: dict, x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), model["base"])
    if model["trees"]:
        b, rows = binned(x, model["edges"]), np.arange(len(x))
        for splits, leaf in model["trees"]:
            node = np.zeros(len(x), np.int64)
            for at in splits:
                f, t = at[node].T
                node = 2 * node + (b[rows, f] > t)
            score += leaf[node]
    return score


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of y on score, by pooling adjacent violators.

    A row of each class is added at the ends as a prior, so no probability is 0 or 1.
    """
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, least score, greatest score
    for s, v in zip([score.min() - 1, *score[order], score.max() + 1] if len(score) else [-1.0, 1.0], [0.5, *y[order], 0.5] if len(score) else [0.0, 1.0], strict=True):
        blocks.append([float(v), 1.0, float(s), float(s)])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    knots = [(k, v / n) for v, n, lo, hi in blocks for k in ([lo, hi] if hi > lo else [lo])]
    return np.array([k for k, _ in knots]), np.array([p for _, p in knots])
