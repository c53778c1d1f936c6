"""A wavelet matrix over a small alphabet, with many queries answered at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with the number of ones before every 64-bit word of it."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(self.size // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are set."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols below ``2 ** levels``; one bit vector per level, highest bit first.

    Each level deals the symbols stably, those with a zero bit first, so a symbol's
    occurrences end side by side and ``rank`` follows two bounds through the levels.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        self.size = len(symbols)
        self.levels: list[tuple[Bits, int]] = []
        now = np.asarray(symbols, np.uint8)
        for level in range(levels - 1, -1, -1):
            bit = (now >> level) & 1
            vector = Bits(bit)
            zeros = self.size - int(vector.before[-1])
            self.levels.append((vector, zeros))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``at`` symbols, for every ``at``."""
        high = np.asarray(at, np.int64)
        low = np.zeros(1, np.int64)
        for k, (vector, zeros) in enumerate(self.levels):
            if symbol >> (len(self.levels) - 1 - k) & 1:
                low, high = zeros + vector.ones(low), zeros + vector.ones(high)
            else:
                low, high = low - vector.ones(low), high - vector.ones(high)
        return high - low

    def ranks(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are one of ``symbols``."""
        return sum(self.rank(symbol, at) for symbol in symbols)

    def select(self, symbols: tuple[int, ...], count: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least place in ``low`` to ``high`` before which ``count`` of the ``symbols`` lie, ``high`` if none.

        By bisection on their ranks, all queries side by side.
        """
        low, high = np.array(low, np.int64), np.array(high, np.int64)
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.ranks(symbols, middle) >= count
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low
