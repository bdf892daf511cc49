"""Elias-Fano coding of a monotone sequence in numpy arrays that can be memory-mapped.

A value splits into low bits, stored as they are, and high bits, stored in unary: a one
per element, a zero after the elements of each high value. A count of zeros per 64-bit
word makes the start of any high value a matter of one binary search and one word.
"""

from __future__ import annotations

import numpy as np

_LOW_KINDS = {0: np.uint8, 8: np.uint8, 16: np.uint16, 32: np.uint32}
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


def _selects(flip: int) -> np.ndarray:
    """[byte, k]: the place of the k-th set bit of byte ^ flip."""
    out = np.zeros((256, 8), np.int64)
    for byte in range(256):
        places = [i for i in range(8) if (byte ^ flip) >> i & 1]
        out[byte, :len(places)] = places
    return out


_ZERO_IN_BYTE, _ONE_IN_BYTE = _selects(255), _selects(0)


def _low_bits(n: int, universe: int) -> int:
    cost = {b: b * n + n + (universe >> b) for b in _LOW_KINDS}
    return min(cost, key=cost.get)


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of the sorted values, each below the universe."""
    n = len(values)
    bits = _low_bits(n, universe)
    values = values.astype(np.int64)
    high = values >> bits
    size = n + (universe >> bits) + 1
    flags = np.zeros((size + 63) // 64 * 64, np.uint8)
    flags[high + np.arange(n)] = 1
    unary = np.packbits(flags, bitorder="little")
    ones = np.cumsum(_ONES[unary].reshape(-1, 8).sum(axis=1))
    ones = np.concatenate(([0], ones)).astype(np.int64)
    low = (values & ((1 << bits) - 1)).astype(_LOW_KINDS[bits]) if bits else np.zeros(0, np.uint8)
    return {"meta": np.array([n, universe, bits], np.int64), "low": low, "unary": unary, "ones": ones}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.universe, self.bits = (int(x) for x in arrays["meta"])
        self.low, self.unary, self.ones = arrays["low"], arrays["unary"], arrays["ones"]
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    def _select(self, k: np.ndarray, counts: np.ndarray, flip: int, table: np.ndarray) -> np.ndarray:
        word = np.searchsorted(counts, k, side="right") - 1
        rest = k - counts[word]
        octets = self.unary[(word[:, None] << 3) + np.arange(8)]
        before = np.cumsum(_ONES[octets ^ np.uint8(flip)], axis=1)
        byte = (before <= rest[:, None]).sum(axis=1)
        inside = rest - np.where(byte > 0, before[np.arange(len(k)), np.maximum(byte - 1, 0)], 0)
        return (word << 6) + (byte << 3) + table[octets[np.arange(len(k)), byte], inside]

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at the positions."""
        high = self._select(i, self.ones, 0, _ONE_IN_BYTE) - i
        return (high << self.bits) | (self.low[i].astype(np.int64) if self.bits else 0)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """For each x the position of the first value not below it (n if none)."""
        return self._search(x)[0]

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the successors, where the elements with the high bits of x end,
        and the low bits of x."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), x
        high = x >> self.bits
        # elements of a high value lie between the zero before and the zero after it
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, 255, _ZERO_IN_BYTE) - high + 1, 0)
        last = self._select(high, self.zeros, 255, _ZERO_IN_BYTE) - high
        if not self.bits:
            return begin, last, np.zeros(len(x), np.int64)
        low = x & ((1 << self.bits) - 1)
        end = last.copy()
        open_ = np.flatnonzero(begin < end)
        while len(open_):  # only those that are still searched
            middle = (begin[open_] + end[open_]) >> 1
            less = self.low[middle] < low[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[begin[open_] < end[open_]]
        return begin, last, low

    def find(self, x: np.ndarray) -> np.ndarray:
        """Positions of the values, -1 for values that are not there."""
        at, last, low = self._search(x)
        there = at < last
        if self.bits:
            there[there] = self.low[at[there]] == low[there]
        return np.where(there, at, -1)
