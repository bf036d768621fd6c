"""Linear-chain conditional random fields in numpy: fitting, and Viterbi over many chains at once."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Chain(NamedTuple):
    """Weights of features by label, of a label after another, and of a first label."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray


def fit(chains: list[tuple[np.ndarray, np.ndarray]], labels: int, width: int, steps: int = 120, l2: float = 1e-3, rate: float = 0.15) -> Chain:
    """Penalised maximum likelihood by full-batch Adam from (features, labels) chains.

    Empty chains are left out; no chains give zero weights.
    """
    chains = sorted((c for c in chains if len(c[1])), key=lambda c: -len(c[1]))
    par = [np.zeros((width, labels)), np.zeros((labels, labels)), np.zeros(labels)]
    if not chains:
        return Chain(*par)
    size = np.array([len(y) for _, y in chains])
    n, t_max, total = len(chains), size[0], size.sum()
    x = np.concatenate([a for a, _ in chains]).astype(np.float32)
    at = (np.repeat(np.arange(n), size), np.arange(total) - np.repeat(np.cumsum(size) - size, size))  # chain, place
    y = np.concatenate([b for _, b in chains])
    hot = np.zeros((n, t_max, labels))
    hot[(*at, y)] = 1
    seen = [x.T.astype(np.float64) @ np.eye(labels)[y], np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:]), hot[:, 0].sum(0)]
    m, v = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    count = [int((size > t).sum()) for t in range(t_max)]
    for step in range(1, steps + 1):
        e = np.zeros((t_max, n, labels))
        e[at[1], at[0]] = x @ par[0].astype(np.float32)
        e[0] += par[2]
        e = np.exp(e - e.max(2, keepdims=True))
        move = np.exp(par[1] - par[1].max())
        # forward and backward sums, of which every step's are scaled to add up to 1
        alpha, beta, scale = np.zeros_like(e), np.ones_like(e), np.ones((t_max, n, 1))
        for t in range(t_max):
            k = count[t]
            now = e[0] if t == 0 else (alpha[t - 1, :k] @ move) * e[t, :k]
            scale[t, :k] = now.sum(1, keepdims=True)
            alpha[t, :k] = now / scale[t, :k]
        pair = np.zeros_like(par[1])
        for t in range(t_max - 1, 0, -1):
            k = count[t]
            after = beta[t, :k] * e[t, :k] / scale[t, :k]
            pair += alpha[t - 1, :k].T @ after
            beta[t - 1, :k] = after @ move.T
        p = alpha * beta
        grad = [x.T @ p[at[1], at[0]].astype(np.float32), pair * move, p[0].sum(0)]
        for i in range(3):
            g = (grad[i] - seen[i]) / total + l2 * par[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            par[i] = par[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return Chain(*par)


def viterbi(emit: np.ndarray, bounds: np.ndarray, chain: Chain) -> np.ndarray:
    """The best label of every position; chain i is emit[bounds[i]:bounds[i+1]].

    All chains advance together, the longest first, so a step is one array operation. Of
    equal paths the one with lower labels wins.
    """
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], bounds[:-1][order]
    out, back = np.zeros(len(emit), np.int64), np.zeros(emit.shape, np.uint8)
    longest = int(size[0]) if len(size) else 0
    if not longest:
        return out
    live = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than t
    n = live[0]
    score = chain.first + emit[begin[:n]]
    for t in range(1, longest):
        n = live[t]
        step = score[:n, :, None] + chain.move
        at = begin[:n] + t
        back[at] = step.argmax(1)
        score[:n] = step.max(1) + emit[at]
    label = score.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        at = begin[:n] + t
        out[at] = label[:n]
        if t:
            label[:n] = back[at, label[:n]]
    return out
