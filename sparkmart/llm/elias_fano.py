"""Elias-Fano coding of monotone sequences, with vectorised access and
successor search over memory-mapped words.

A sequence of n values below u keeps ``l = log2(u / n)`` low bits of each value
in a packed array and the high parts in unary: bit ``(v >> l) + i`` is set for
the i-th value. A count of ones before each 64 bits allows selection; within 64
bits the place is found by adding up bytes side by side in one word.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BYTE_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _r, _at in enumerate([i for i in range(8) if _b >> i & 1]):
        _BYTE_SELECT[_b, _r] = _at
_EACH = _U(0x0101010101010101)      # one in every byte
_TOP = _U(0x8080808080808080)       # the top bit of every byte


def select_in_word(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each word, which has more than k."""
    s = x - ((x >> _U(1)) & _U(0x5555555555555555))
    s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
    s = (s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)
    upto = s * _EACH                                                    # ones up to and with each byte
    shift = np.bitwise_count(((k * _EACH | _TOP) - upto) & _TOP).astype(np.uint64) << _U(3)     # bytes that hold too few
    before = (upto << _U(8)) >> shift & _U(255)
    return shift.astype(np.int64) + _BYTE_SELECT[(x >> shift & _U(255)).astype(np.int64), (k - before).astype(np.int64)]


def encode(values: np.ndarray) -> bytes:
    """``values``: uint64, not decreasing. A header of 6 words, then the arrays."""
    n = len(values)
    offset = int(values[0]) if n else 0
    v = values - _U(offset)
    top = int(v[-1]) if n else 0
    low = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
    high = (v >> _U(low)).astype(np.int64)
    bits = (n + (top >> low) + 1 + 511) // 512 * 512
    raised = np.zeros(bits, np.uint8)
    raised[high + np.arange(n)] = 1
    words = np.packbits(raised, bitorder="little").view(np.uint64)
    if n >= 1 << 32 or bits - n >= 1 << 32:
        raise ValueError("a sequence holds fewer than 2**32 values: use more shards")
    ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
    ones = np.concatenate([[0], ones[:-1]]).astype(np.uint32).view(np.uint64)      # their number is a multiple of 8
    packed = np.zeros((n * low + 63) // 64 + 1, np.uint64)
    if low and n:
        part = v & _U((1 << low) - 1)
        at = np.arange(n, dtype=np.uint64) * _U(low)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        _or_at(packed, word, part << shift)
        over = shift + _U(low) > 64
        _or_at(packed, word[over] + 1, part[over] >> (_U(64) - shift[over]))
    head = np.array([n, offset & (1 << 64) - 1, low, len(words), len(ones), len(packed)], np.uint64)
    return head.tobytes() + words.tobytes() + ones.tobytes() + packed.tobytes()


def _or_at(out: np.ndarray, where: np.ndarray, values: np.ndarray) -> None:
    """out[where] |= values for not decreasing ``where``."""
    if len(where):
        first = np.flatnonzero(np.diff(where, prepend=-1))
        out[where[first]] |= np.bitwise_or.reduceat(values, first)


class Sequence:
    """A coded sequence over a buffer of uint64 words (a memory map)."""

    def __init__(self, words: np.ndarray):
        words = np.asarray(words)
        self.n, offset, self.low, a, b, c = (int(x) for x in words[:6])
        self.offset = _U(offset)
        self.bits, self.packed = words[6:6 + a], words[6 + a + b:6 + a + b + c]
        self.ones = words[6 + a:6 + a + b].view(np.uint32)
        self.size = 6 + a + b + c
        self.zeros = (np.arange(a, dtype=np.int64) * 64 - self.ones).astype(np.uint32)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (from 0) set or unset bit."""
        counts = self.ones if one else self.zeros
        word = np.searchsorted(counts, k.astype(np.uint32), side="right") - 1
        bits = self.bits[word]
        return word * 64 + select_in_word(bits if one else ~bits, k - counts[word])

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.low)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        v = self.packed[word] >> shift
        over = shift + _U(self.low) > 64
        v[over] |= self.packed[word[over] + 1] << (_U(64) - shift[over])
        return v & _U((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = (self._select(i.astype(np.uint64), True) - i).astype(np.uint64)
        return (high << _U(self.low) | self._lows(i)) + self.offset

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of the first element equal to each value, -1 where there is none."""
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        v = values - self.offset
        buckets = int(len(self.bits)) * 64 - self.n
        ok = np.flatnonzero((values >= self.offset) & (v >> _U(self.low) < _U(buckets)))
        v = v[ok]
        high = v >> _U(self.low)
        lo = np.zeros(len(v), np.int64)          # elements before the bucket
        some = np.flatnonzero(high > 0)
        lo[some] = self._select(high[some] - _U(1), False) - (high[some] - _U(1)).astype(np.int64)
        hi = self._select(high, False) - high.astype(np.int64)
        want = v & _U((1 << self.low) - 1)
        lo_end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            less = self._lows(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        hit = np.flatnonzero(lo < lo_end)
        hit = hit[self._lows(lo[hit]) == want[hit]]
        out[ok[hit]] = lo[hit]
        return out

    def find_between(self, values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """An index in [lo, hi) of each value, -1 where it does not lie there."""
        out, lo, hi = np.full(len(values), -1, np.int64), lo.astype(np.int64), hi.astype(np.int64)
        left = np.flatnonzero(lo < hi)
        while len(left):
            mid = (lo[left] + hi[left]) // 2
            got, want = self.access(mid), values[left]
            out[left[got == want]] = mid[got == want]
            lo[left[got < want]] = mid[got < want] + 1
            hi[left[got > want]] = mid[got > want]
            left = left[(lo[left] < hi[left]) & (got != want)]
        return out
