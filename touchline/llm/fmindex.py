"""An FM-index over a sequence of symbols: backward search through wavelet-matrix ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by doubling the sorted prefix length. The last symbol must be the only smallest."""
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    n, k = len(s), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        if rank[order[-1]] == n - 1 or k >= n:
            return order
        k *= 2


class FMIndex:
    """Symbols are whole numbers below ``size``; symbol 0 ends the sequence and occurs nowhere else."""

    def __init__(self, s: np.ndarray, size: int):
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=size))])  # symbols smaller than each
        self.levels = max(1, int(size - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):  # a wavelet matrix: from the highest bit, zeros before ones
            bit = (bwt >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bwt) - bit.sum()))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        self.marked = sa % SAMPLE == 0
        self.mark_rank = np.cumsum(self.marked) - 1
        self.samples = sa[self.marked]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first ``i`` entries of the transform."""
        start = np.zeros_like(i)
        for k in range(self.levels):
            ones = self.ones[k]
            bit = (symbol >> (self.levels - 1 - k)) & 1
            i = np.where(bit, self.zeros[k] + ones[i], i - ones[i])
            start = np.where(bit, self.zeros[k] + ones[start], start - ones[start])
        return i - start

    def previous(self, i: np.ndarray) -> np.ndarray:
        """For the suffix at each place of the order, the place of the suffix one symbol longer."""
        symbol, at, start = np.zeros_like(i), i, np.zeros_like(i)
        for k in range(self.levels):
            ones = self.ones[k]
            bit = ones[at + 1] - ones[at]
            symbol = symbol * 2 + bit
            at = np.where(bit, self.zeros[k] + ones[at], at - ones[at])
            start = np.where(bit, self.zeros[k] + ones[start], start - ones[start])
        return self.before[symbol] + at - start

    def search(self, sequence: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases ``sequence[first:first + length]`` the range of suffixes that begin with them."""
        lo = np.zeros(len(first), np.int64)
        hi = np.full(len(first), self.before[-1], np.int64)
        live = np.arange(len(first))
        for step in range(int(length.max(initial=0))):
            live = live[(step < length[live]) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = sequence[first[live] + length[live] - 1 - step]
            lo[live] = self.before[c] + self.rank(c, lo[live])
            hi[live] = self.before[c] + self.rank(c, hi[live])
        return lo, hi

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes at ``places``: steps back to the next sampled one."""
        at, steps = places.astype(np.int64), np.zeros(len(places), np.int64)
        live = np.flatnonzero(~self.marked[at])
        while len(live):
            at[live] = self.previous(at[live])
            steps[live] += 1
            live = live[~self.marked[at[live]]]
        return self.samples[self.mark_rank[at]] + steps
