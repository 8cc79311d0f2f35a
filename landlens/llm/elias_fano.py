"""Elias-Fano sequences: n rising 64-bit values in about 2 + log2(range / n) bits each, searched in place.

The low bits of the values are packed one after the other; the high parts are a bit
vector with a one for each value and a zero for each step of the high part.  Both,
and the directory of ones, are plain words that can be mapped or stored as they are
(``to_bytes`` / ``from_bytes``).  All operations work on whole arrays of queries.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ONE, _ALL = _U(1), _U(0xFFFFFFFFFFFFFFFF)


def _or_into(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """words[at] |= bits for non-falling ``at``."""
    if len(at):
        first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        words[at[first]] |= np.bitwise_or.reduceat(bits, first)


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones_before = np.cumsum(ones) - ones
        self.zeros_before = np.arange(len(high)) * 64 - self.ones_before
        self.mask = _U((1 << low_bits) - 1)

    @classmethod
    def build(cls, values: np.ndarray, top: int | None = None) -> EliasFano:
        """Of non-falling values (uint64), all at most ``top``."""
        n = len(values)
        top = int(values[-1]) if top is None and n else top or 0
        low_bits = max(0, min(62, (top // max(n, 1)).bit_length() - 1)) if n else 0
        low = np.zeros(n * low_bits // 64 + 2, np.uint64)
        mask = _U((1 << low_bits) - 1)
        if low_bits:
            at = np.arange(n, dtype=np.int64) * low_bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            part = values & mask
            _or_into(low, word, part << shift)
            over = shift + _U(low_bits) > _U(64)
            _or_into(low, word[over] + 1, part[over] >> (_U(64) - shift[over]))
        place = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((n + (top >> low_bits) + 1) // 64 + 2, np.uint64)
        _or_into(high, place >> 6, _ONE << (place & 63).astype(np.uint64))
        return cls(n, low_bits, low, high)

    def to_bytes(self) -> bytes:
        return np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.int64).tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data, at: int = 0) -> tuple[EliasFano, int]:
        """A view of the bytes (nothing is copied), and where it ends."""
        n, low_bits, a, b = (int(x) for x in np.frombuffer(data, np.int64, 4, at))
        low, high = np.frombuffer(data, np.uint64, a, at + 32), np.frombuffer(data, np.uint64, b, at + 32 + 8 * a)
        return cls(n, low_bits, low, high), at + 32 + 8 * (a + b)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        right = self.low[word] >> shift
        left = np.where(shift > 0, self.low[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
        return (right | left) & self.mask

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero of the high bits."""
        before = self.ones_before if ones else self.zeros_before
        word = np.searchsorted(before, k, side="right") - 1
        bits = self.high[word] if ones else ~self.high[word]
        rest = k - before[word]
        at = np.zeros(len(k), np.uint64)
        for step in (32, 16, 8, 4, 2, 1):
            part = np.bitwise_count((bits >> at) & _U((1 << step) - 1)).astype(np.int64)
            on = rest >= part
            rest -= np.where(on, part, 0)
            at += np.where(on, _U(step), _U(0))
        return word * 64 + at.astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        i = np.asarray(i, np.int64)
        return ((self._select(i, True) - i).astype(np.uint64) << _U(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """For each x the place of the first value that is not smaller (n if there is none)."""
        x = np.asarray(x, np.uint64)
        part = x >> _U(self.low_bits)
        steps = len(self.high) * 64 - int(self.ones_before[-1] + np.bitwise_count(self.high[-1])) if len(self.high) else 0
        beyond = part >= _U(max(steps - 1, 0))
        q = np.where(beyond, 0, part).astype(np.int64)
        a = np.where(q > 0, self._select(np.maximum(q - 1, 0), False) + 1 - q, 0)
        b = self._select(q, False) - q
        want, rest = x & self.mask, b.copy()
        while (open_ := a < rest).any():  # binary search among the values of one high part
            mid = (a + rest) >> 1
            less = open_ & (self._low(np.minimum(mid, max(self.n - 1, 0))) < want)
            a = np.where(less, mid + 1, a)
            rest = np.where(open_ & ~less, mid, rest)
        return np.where(beyond, self.n, a)

    def find(self, x: np.ndarray) -> np.ndarray:
        """For each x its place, -1 if it is no value."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at = self.successor(x)
        inside = np.minimum(at, self.n - 1)
        return np.where((at < self.n) & (self.get(inside) == np.asarray(x, np.uint64)), inside, -1)
