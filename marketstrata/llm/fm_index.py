"""A compressed index over word sequences: BWT in a wavelet matrix, searched backwards."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits packed 64 to a word, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded.reshape(-1, 8), axis=1, bitorder="little").reshape(-1).view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank of any symbol before any position, in one step a bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.levels: list[BitRank] = []
        for shift in range(self.depth - 1, -1, -1):
            bits = ((symbols >> shift) & 1).astype(np.uint8)
            self.levels.append(BitRank(bits))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))
        every = np.arange(alphabet)
        self.first = self._descend(every, np.zeros(alphabet, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(self.levels):
            ones = level.ones(at)
            at = np.where((symbols >> (self.depth - 1 - k)) & 1, level.zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._descend(symbols, at) - self.first[symbols]


class WindowIndex:
    """FM-index over texts of words for patterns up to ``window`` words; every text has a value.

    Suffixes are sorted by their first ``window`` words, which is as deep as any pattern reaches; suffixes
    equal so far form a class, whose least value is kept. Words are numbered from 1, 0 ends a text.
    """

    def __init__(self, texts: list[np.ndarray], values: np.ndarray, window: int):
        self.window = window
        sizes = np.array([len(t) + 1 for t in texts])
        seq = np.zeros(sizes.sum(), np.int64)
        starts = np.cumsum(sizes) - sizes
        for s, t in zip(starts.tolist(), texts, strict=True):
            seq[s : s + len(t)] = t
        n = len(seq)
        owner = np.repeat(np.arange(len(texts)), sizes)

        def paired(rank: np.ndarray, step: int) -> np.ndarray:
            ahead = np.zeros(n, np.int64)
            ahead[: n - step] = rank[step:] if step < n else 0
            return np.unique(rank * (n + 1) + ahead + 1, return_inverse=True)[1]

        rank, reach = np.unique(seq, return_inverse=True)[1], 1
        while reach * 2 <= window:
            rank, reach = paired(rank, reach), reach * 2
        if reach < window:
            rank = paired(rank, window - reach)  # the two halves overlap
        order = np.argsort(rank, kind="stable")
        self.classes = rank[order]
        self.starts = np.flatnonzero(np.diff(self.classes, prepend=-1))
        self.ends = np.append(self.starts[1:], n)
        self.least = np.minimum.reduceat(values[owner[order]], self.starts)
        alphabet = int(seq.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=alphabet))))
        self.bwt = WaveletMatrix(seq[order - 1], alphabet)
        self.size = n

    def matching(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """For each window of each text, the least value of the indexed texts that hold it; -1: none.

        All texts are searched backwards in step. A match that reaches the window's length is reported and
        cut back to it by widening its interval to the whole class; a failed one starts again.
        """
        lanes, sizes = len(texts), np.array([len(t) for t in texts])
        width = int(sizes.max(initial=0))
        grid = np.zeros((lanes, width), np.int64)  # right-aligned words
        for k, t in enumerate(texts):
            grid[k, width - len(t) :] = t
        out = np.full((lanes, width), -1, np.int64)
        low, high, length = np.zeros(lanes, np.int64), np.full(lanes, self.size), np.zeros(lanes, np.int64)
        for step in range(1, width + 1):
            live = np.flatnonzero(sizes >= step)
            word = grid[live, width - step]
            known = word < len(self.before) - 1
            word = np.where(known, word, 0)
            both = self.bwt.rank(np.concatenate((word, word)), np.concatenate((low[live], high[live])))
            lo, hi = self.before[word] + both[: len(live)], self.before[word] + both[len(live) :]
            found = known & (hi > lo)
            low[live], high[live] = np.where(found, lo, 0), np.where(found, hi, self.size)
            length[live] = np.where(found, length[live] + 1, 0)
            whole = live[length[live] >= self.window]
            group = self.classes[low[whole]]
            out[whole, width - step] = self.least[group]
            low[whole], high[whole] = self.starts[group], self.ends[group]
            length[whole] = self.window
        return [out[k, width - s : width - self.window + 1] for k, s in enumerate(sizes.tolist())]
