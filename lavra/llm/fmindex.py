"""A compressed FM-index over word numbers: a wavelet matrix of the Burrows-Wheeler transform.

All queries of a shard are searched together: a step of the backward search is a few vector
operations over those that are still alive.
"""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` symbols, by prefix doubling."""
    rank = text.astype(np.int64)
    order = np.argsort(rank)
    done = 1
    while done < depth:
        behind = np.zeros(len(rank), np.int64)
        behind[:-done] = rank[done:] + 1
        key = rank * (int(behind.max()) + 1) + behind
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == len(rank) - 1:
            break
        done *= 2
    return order


class WaveletMatrix:
    """Rank of any symbol at any place, in one bit a level and symbol and a count a 64 bits."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels = max(1, int(most).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level & 1).astype(np.uint8)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.bits.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.uint32)[:-1])).astype(np.uint32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))
        every = np.arange(most + 1)
        self.base = self._down(every, np.zeros(len(every), np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, words, counts, zeros in zip(reversed(range(self.levels)), self.bits, self.counts, self.zeros):
            block = at >> 6
            below = words[block] & ((ONE << (at & 63).astype(np.uint64)) - ONE)
            ones = counts[block].astype(np.int64) + np.bitwise_count(below)
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, at) - self.base[symbols]


class FMIndex:
    """Index of a text of symbols; 0 separates its parts and is never matched."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text = text
        self.order = suffix_order(text, depth)
        self.most = int(text.max())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.most + 1))))
        self.ranks = WaveletMatrix(text[self.order - 1], self.most)

    def repeated(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the text against itself, up to ``length``, and the full matches.

        Returns, for every place, the length of the longest match that ends there and occurs at
        least twice (at most ``length``); the places where a match of the full length starts; and
        the first place where the same symbols start.
        """
        end = np.flatnonzero(self.text)
        symbol = self.text[end]
        low, high = self.first[symbol], self.first[symbol + 1]
        longest = np.zeros(len(self.text), np.int64)
        for step in range(1, length + 1):
            alive = high - low > 1
            end, low, high = end[alive], low[alive], high[alive]
            longest[end] = step
            if step == length:
                break
            front = end - step
            symbol = np.where(front >= 0, self.text[front], 0)
            inside = symbol > 0
            end, low, high, symbol = end[inside], low[inside], high[inside], symbol[inside]
            low, high = (self.first[symbol] + self.ranks.rank(symbol, x) for x in (low, high))
        start = end - length + 1
        if not len(start):
            return longest, start, start
        lows, which = np.unique(low, return_index=True)
        highs = high[which]
        ends = np.stack((lows, highs), axis=1).ravel()
        least = np.minimum.reduceat(np.append(self.order, len(self.order)), ends)[::2]
        return longest, start, least[np.searchsorted(lows, low)]
