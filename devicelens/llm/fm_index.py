"""An FM-index over word symbols: suffix order, wavelet matrix, backward search, locate.

Everything is vectorised over arrays of queries; one index covers one training shard.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 32  # text positions between sampled suffixes


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order of symbols >= 0 by prefix doubling over what is still tied.

    Ends of pieces must be distinct symbols, so no two suffixes stay equal."""
    n = len(s)
    bits = int(s.max() + 1).bit_length()
    h = max(1, 63 // bits)
    padded = np.concatenate([s.astype(np.int64) + 1, np.zeros(h, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(h):
        key = (key << bits) | padded[k:k + n]
    order = np.argsort(key)
    key = key[order]
    start = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(start)[np.cumsum(start) - 1]
    at = np.flatnonzero(~(start & np.append(start[1:], True)))  # places of tied suffixes
    while len(at):
        tied = order[at]
        key = rank[tied] * (n + 2) + rank[np.minimum(tied + h, n)] + 1
        by = np.argsort(key)
        key, tied = key[by], tied[by]
        order[at] = tied
        start = np.concatenate([[True], key[1:] != key[:-1]])
        rank[tied] = at[np.flatnonzero(start)][np.cumsum(start) - 1]
        at = at[~(start & np.append(start[1:], True))]
        h *= 2
    return order


class Bits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.ranks[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


class FMIndex:
    def __init__(self, s: np.ndarray):
        n = self.n = len(s)
        order = suffix_array(s)
        bwt = s[order - 1]
        size = int(s.max()) + 1
        counts = np.bincount(s, minlength=size)
        self.before = np.cumsum(counts) - counts            # rows that start with a lesser symbol
        self.levels: list[tuple[int, Bits, int]] = []       # (shift, bits, zeros)
        for shift in range(max(1, (size - 1).bit_length()) - 1, -1, -1):
            one = ((bwt >> shift) & 1).astype(bool)
            self.levels.append((shift, Bits(one), int(n - one.sum())))
            bwt = np.concatenate([bwt[~one], bwt[one]])
        first = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.at = np.zeros(size, np.int64)                  # where a symbol begins below the last level
        self.at[bwt[first]] = first
        sampled = order % SAMPLE == 0
        self.sampled, self.samples = Bits(sampled), order[sampled]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows below ``row`` whose text is preceded by ``symbol``, as the row they map to."""
        row = row.copy()
        for shift, bits, zeros in self.levels:
            ones = bits.rank(row)
            row = np.where((symbol >> shift) & 1, zeros + ones, row - ones)
        return self.before[symbol] + row - self.at[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one symbol longer."""
        row, symbol = row.copy(), np.zeros(len(row), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(row), bits.rank(row)
            symbol |= one.astype(np.int64) << shift
            row = np.where(one, zeros + ones, row - ones)
        return self.before[symbol] + row - self.at[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, end row) of those that occur. ``patterns``: symbols, flush
        right, of which the last ``lengths`` count."""
        live = np.arange(len(patterns))
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.n)
        width = patterns.shape[1]
        for k in range(width):
            on = lengths[live] > k
            if not on.any():
                break
            symbol = patterns[live[on], width - 1 - k]
            both = self.step(np.concatenate([symbol, symbol]), np.concatenate([low[on], high[on]]))
            low[on], high[on] = both[:len(symbol)], both[len(symbol):]
            some = low < high
            live, low, high = live[some], low[some], high[some]
        return live, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to the nearest sampled suffix."""
        out = np.zeros(len(rows), np.int64)
        at, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(at):
            hit = self.sampled.get(row)
            out[at[hit]] = self.samples[self.sampled.rank(row[hit])] + steps
            at, row = at[~hit], row[~hit]
            if len(at):
                row = self.back(row)
            steps += 1
        return out
