"""FM-index over the words of one shard: suffix array, wavelet matrix of the BWT, sampled positions; searched in vectors."""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every so many positions of a run keep their place in the text


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling. Symbols are non-negative; unique separators bound the rounds."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (max(n, int(rank.max())) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, bool)
        fresh[0] = False
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class BitRank:
    """A bit vector with constant-time counts of the ones before a place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Counts of a symbol before a place, and the symbol at a place, in one step per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for level in reversed(range(max(1, int(top).bit_length()))):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append((level, BitRank(bits), int((~bits).sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        start = np.zeros_like(at)
        for level, bits, zeros in self.levels:
            one = symbol >> level & 1 == 1
            a, s = bits.ones(at), bits.ones(start)
            at, start = np.where(one, zeros + a, at - a), np.where(one, zeros + s, start - s)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for level, bits, zeros in self.levels:
            one, a = bits.get(at), bits.ones(at)
            symbol |= one.astype(np.int64) << level
            at = np.where(one, zeros + a, at - a)
        return symbol


class FMIndex:
    """Index of runs of symbols 1..top, laid end to end; a match never crosses from one run into the next."""

    def __init__(self, runs: list[np.ndarray], top: int):
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        self.starts = np.cumsum(sizes + 1) - sizes - 1  # each run is followed by its separator
        n = int((sizes + 1).sum())
        text = np.zeros(n, np.int64)
        for run, at in zip(runs, self.starts.tolist()):
            text[at : at + len(run)] = run
        ends = self.starts + sizes
        unique = text + len(runs)
        unique[ends] = np.arange(len(runs))  # separators sort first, each one different
        order = suffix_array(unique)
        bwt = text[order - 1]
        self.bwt = WaveletMatrix(bwt, top)
        counts = np.bincount(text, minlength=top + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])[: top + 1]
        # Kept places: every SAMPLE-th of a run, its first one, and the separators.
        run_of = np.repeat(np.arange(len(runs)), sizes + 1)
        kept = ((np.arange(n) - self.starts[run_of]) % SAMPLE == 0) | (text == 0)
        self.marked = BitRank(kept[order])
        self.kept = order[kept[order]]
        self.n = n

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range ``[low, high)`` of each row of equally long phrases, by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            c = phrases[alive, column]
            low[alive] = self.first[c] + self.bwt.rank(c, low[alive])
            high[alive] = self.first[c] + self.bwt.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
        high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes: steps back through the BWT until a sampled one is met."""
        found, steps, left, at = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows
        while len(left):
            kept = self.marked.get(at)
            found[left[kept]] = self.kept[self.marked.ones(at[kept])] + steps
            left, at = left[~kept], at[~kept]
            c = self.bwt.access(at)
            at = self.first[c] + self.bwt.rank(c, at)
            steps += 1
        return found
