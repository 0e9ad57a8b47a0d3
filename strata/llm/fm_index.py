"""FM-index over a sequence of small integers: wavelet-matrix ranks, backward
search of many patterns at a time, and locating by sampled suffix positions.
Plain numpy; a task builds one for each shard of text that it holds."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Prefix doubling; ``seq`` ends with its only least symbol."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
        rank = new
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class Bits:
    """A bit vector with ranks: set bits before a position."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.ones = int(counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    def __init__(self, seq: np.ndarray, n_bits: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(n_bits - 1, -1, -1):
            bit = (seq >> shift) & 1 != 0
            bits = Bits(bit)
            self.levels.append((shift, bits, len(seq) - bits.ones))
            seq = np.concatenate((seq[~bit], seq[bit]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``i``."""
        start = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift) & 1 != 0
            a, b = bits.rank(start), bits.rank(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def get(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(i), np.int64)
        for shift, bits, zeros in self.levels:
            one = bits.get(i)
            symbol |= one.astype(np.int64) << shift
            a = bits.rank(i)
            i = np.where(one, zeros + a, i - a)
        return symbol


class FmIndex:
    def __init__(self, seq: np.ndarray, n_symbols: int):
        """``seq`` holds symbols from 1 to ``n_symbols - 1``; 0 is put at its end."""
        seq = np.append(seq, 0)
        order = suffix_array(seq)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=n_symbols))))
        self.bwt = WaveletMatrix(seq[order - 1], max(1, (n_symbols - 1).bit_length()))
        sampled = order % SAMPLE == 0
        self.sampled, self.samples = Bits(sampled), order[sampled]
        self.n = len(seq)

    def find(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns (rows, right-aligned): the numbers of
        those that occur, and their suffix ranges (low, high)."""
        live = np.arange(len(patterns))
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.n)
        width = patterns.shape[1]
        for back in range(1, width + 1):
            on = lengths[live] >= back          # shorter ones are done and keep their range
            c = patterns[live[on], width - back]
            low[on] = self.first[c] + self.bwt.rank(c, low[on])
            high[on] = self.first[c] + self.bwt.rank(c, high[on])
            some = low < high
            live, low, high = live[some], low[some], high[some]
        return live, np.stack((low, high), axis=1)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows, stepping back to a sampled one."""
        found = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.sampled.get(at)
            found[todo[hit]] = self.samples[self.sampled.rank(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            symbol = self.bwt.get(at)
            at = self.first[symbol] + self.bwt.rank(symbol, at)
            steps += 1
        return found
