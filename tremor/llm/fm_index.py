"""FM-index over integer symbols with a wavelet matrix, all queries in lockstep.

Bit vectors are packed into 64-bit words with one count per word, so the index
takes about 1.5 bits per symbol and level. ``search`` runs backward search for
many patterns at once and drops a pattern as soon as its interval is empty.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def suffix_array(text: np.ndarray, reach: int) -> np.ndarray:
    """Order of all suffixes by their first ``reach`` symbols at least (prefix doubling)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < reach and n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


class WaveletMatrix:
    """Rank of a symbol among the first i symbols."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        level = symbols
        for k in range(self.levels - 1, -1, -1):
            bit = (level >> k) & 1
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[: self.n] = bit
            word = np.packbits(padded, bitorder="little").view(U64)
            self.words.append(word)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(word), dtype=np.int64)]))
            self.zeros.append(self.n - int(bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        # first place of each symbol's zone on the last level
        self.start = np.zeros(int(symbols.max(initial=0)) + 2, np.int64)
        place = np.zeros(len(self.start), np.int64)
        for k, z in zip(range(self.levels - 1, -1, -1), range(self.levels)):
            one = (np.arange(len(place)) >> k) & 1 == 1
            ones = self._ones(z, place)
            place = np.where(one, self.zeros[z] + ones, place - ones)
        self.start = place

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.counts[level][w] + np.bitwise_count(self.words[level][w] & mask)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        place = i
        for z, k in enumerate(range(self.levels - 1, -1, -1)):
            ones = self._ones(z, place)
            place = np.where((symbol >> k) & 1 == 1, self.zeros[z] + ones, place - ones)
        return place - self.start[symbol]


class FMIndex:
    """Index of ``text`` (symbols from 1; 0 only as separator), exact for patterns up to ``reach`` symbols."""

    def __init__(self, text: np.ndarray, reach: int):
        self.order = suffix_array(text, reach)
        bwt = text[self.order - 1]
        self.tree = WaveletMatrix(bwt)
        size = int(text.max(initial=0)) + 2
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size - 1))]).astype(np.int64)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, high, matched symbols) of each row of ``patterns``: the interval of its longest found suffix."""
        q, m = patterns.shape
        lo, hi, matched = np.zeros(q, np.int64), np.full(q, len(self.order), np.int64), np.zeros(q, np.int64)
        alive = np.arange(q)
        for k in range(m - 1, -1, -1):
            c = patterns[alive, k]
            known = c < len(self.first) - 1
            c = np.where(known, c, 0)
            a = self.first[c] + self.tree.rank(c, lo[alive])
            b = self.first[c] + self.tree.rank(c, hi[alive])
            on = known & (a < b)
            alive = alive[on]
            lo[alive], hi[alive] = a[on], b[on]
            matched[alive] += 1
        return lo, hi, matched


class RangeMinimum:
    """Least value of any interval (sparse table)."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def query(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        out = np.empty(len(lo), np.int64)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.rows[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out
