"""A compressed FM-index over sequences of words, searched for many queries at once.

The Burrows-Wheeler transform of the sequences is kept as a wavelet tree, level by level:
packed bits with a count for every 64. Backward search takes all queries one word further
in each step; where a word can't be added in front, the match is shortened from behind to the
parent of its interval, by the longest common prefixes of neighbouring suffixes. The owners
of suffixes (ranks of document ids) are kept with range minima, so that a match counts only
while a document of smaller id has it.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, by prefix doubling, and the longest common prefix of each with the one before.

    A shorter suffix precedes those it begins. The first prefix is -1, and so is one past the last.
    """
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    ranks = [rank.astype(np.int32) + 1]  # by the first 1, 2, 4, ... symbols
    k = 1
    while True:
        rank = ranks[-1].astype(np.int64)
        after = np.zeros(n, np.int64)
        after[: max(n - k, 0)] = rank[k:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int32)
        new[order] = np.cumsum(np.concatenate([[1], key[order][1:] != key[order][:-1]]))
        k *= 2
        if n == 0 or new[order[-1]] == n or k >= n:
            break
        ranks.append(new)
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        wide = np.concatenate([ranks[level], [0, -1]])  # past the end nothing is alike
        same = wide[np.minimum(a, n)] == wide[np.where(b < n, b, n + 1)]
        step = np.where(same, 1 << level, 0)
        a, b, common = a + step, b + step, common + step
    return order, np.concatenate([[-1], common, [-1]])[: n + 1] if n else np.array([-1])


def _smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before with a smaller value; 0 where there is none."""
    at = np.maximum(np.arange(len(values)) - 1, 0)
    while True:
        far = (values[at] >= values) & (at > 0)
        if not far.any():
            return at
        at[far] = at[at[far]]


class WaveletTree:
    """Ranks of symbols in a sequence of small whole numbers."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(np.uint8)
            full = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            full[: len(bit)] = bit
            words = np.packbits(full, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.base = self._down(np.zeros(sigma, np.int64), np.arange(sigma))

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for i in range(self.bits):
            cell, one = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[i][cell] + np.bitwise_count(self.words[i][cell] & one)
            at = np.where(symbol >> (self.bits - 1 - i) & 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``at`` ones."""
        return self._down(at, symbol) - self.base[symbol]


class FMIndex:
    """An index of ``sequences`` (arrays of 64-bit words), each with an owner."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray):
        size = np.array([len(s) + 1 for s in sequences], np.int64)
        flat = np.concatenate(sequences) if sequences else np.zeros(0, np.int64)
        self.vocabulary, ids = np.unique(flat, return_inverse=True)
        ends = np.cumsum(size) - 1
        text = np.zeros(int(size.sum()), np.int64)  # 0 ends a sequence
        inner = np.ones(len(text), bool)
        inner[ends] = False
        text[inner] = ids + 1
        self.n, sigma = len(text), len(self.vocabulary) + 1
        order, self.common = suffix_array(text)
        self.before = _smaller(self.common)
        self.after = self.n - _smaller(self.common[::-1])[::-1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.tree = WaveletTree(text[order - 1], sigma)
        self.owner_ids = np.unique(owners)
        owner = np.repeat(np.searchsorted(self.owner_ids, owners), size)[order].astype(np.int32)
        self.minima = [owner]
        while 2 << (len(self.minima) - 1) <= self.n:
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; 0 for those the index lacks."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rank of the smallest owner of suffixes lo to hi (not empty)."""
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.minima[k][lo[m]], self.minima[k][hi[m] - (1 << int(k))])
        return out

    def matches(self, queries: list[np.ndarray], owners: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
        """For each query, the matches of at least ``least`` words that a smaller owner has.

        These are the matching statistics of each query from its end to its start: a match is
        extended in front while it occurs with a smaller owner. Where it can't be, it is
        reported if it is long enough, and shortened from behind until it can; no window that
        ends later holds the next word. All queries advance together.
        """
        out: list[list[tuple[int, int]]] = [[] for _ in queries]
        size = np.array([len(q) for q in queries], np.int64)
        base = np.concatenate([[0], np.cumsum(size)])
        symbol = self.symbols(np.concatenate(queries)) if queries else np.zeros(0, np.int64)
        limit = np.searchsorted(self.owner_ids, owners)  # owners of smaller rank are smaller
        live = np.flatnonzero((size >= least) & (limit > 0))
        at, end = size[live].copy(), size[live].copy()
        lo, hi, grew = np.zeros(len(live), np.int64), np.full(len(live), self.n), np.zeros(len(live), bool)
        while len(live):
            c = symbol[base[live] + at - 1]
            both = self.tree.rank(np.concatenate([lo, hi]), np.concatenate([c, c]))
            new_lo, new_hi = self.first[c] + both[: len(c)], self.first[c] + both[len(c) :]
            ok = (c > 0) & (new_lo < new_hi)
            where = np.flatnonzero(ok)
            ok[where] = self.least_owner(new_lo[where], new_hi[where]) < limit[live[where]]
            lo, hi, at = np.where(ok, new_lo, lo), np.where(ok, new_hi, hi), at - ok
            stop = np.flatnonzero(~ok | (at == 0))
            for i in stop[(grew | ok)[stop] & (end[stop] - at[stop] >= least)]:
                out[live[i]].append((int(at[i]), int(end[i])))
            grew = ok
            f = np.flatnonzero(~ok)
            # to the parent interval, or past a word that doesn't occur
            left, right = self.common[lo[f]], self.common[hi[f]]
            none = at[f] == end[f]
            length = np.maximum(np.maximum(left, right), 0)
            lo[f], hi[f] = np.where(none | (length == 0), 0, np.where(left >= right, self.before[lo[f]], lo[f])), np.where(none | (length == 0), self.n, np.where(right >= left, self.after[hi[f]], hi[f]))
            at[f] -= none
            end[f] = at[f] + np.where(none, 0, length)
            keep = (at > 0) & (end >= least)
            if not keep.all():
                live, at, end, lo, hi, grew = (v[keep] for v in (live, at, end, lo, hi, grew))
        return out
