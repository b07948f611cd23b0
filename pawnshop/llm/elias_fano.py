"""Elias-Fano coded monotone sequences, read many positions at once from mapped memory."""

from __future__ import annotations

import numpy as np

_BLOCK = 512
_IN_BYTE = np.zeros((256, 8), np.uint8)  # place of the k-th 1 in a byte
for _b in range(256):
    _ones = [k for k in range(8) if _b >> k & 1]
    _IN_BYTE[_b, :len(_ones)] = _ones


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` of ``width`` bits each, one after the other, in 64-bit words."""
    total = len(values) * width
    out = np.zeros(total // 64 + 2, np.uint64)
    if not width or not len(values):
        return out
    bit = np.arange(len(values), dtype=np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    out[word[first]] += np.add.reduceat(values << shift, first)
    over = np.flatnonzero(shift.astype(np.int64) + width > 64)
    out[word[over] + 1] += values[over] >> (np.uint64(64) - shift[over])
    return out


def encode(values: np.ndarray, universe: int) -> bytes:
    """Code of sorted values (uint64) below ``universe``: about 2 + log2(universe / n) bits each."""
    n = len(values)
    low = int(min(56, max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)))
    high = (values >> np.uint64(low)).astype(np.int64)
    bits = n + (max(universe - 1, 0) >> low) + 1
    marks = np.zeros(-(-(bits + 1) // _BLOCK) * _BLOCK, np.uint8)
    marks[high + np.arange(n)] = 1
    upper = np.packbits(marks, bitorder="little")
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper.view(np.uint64)).reshape(-1, 8).sum(1, dtype=np.int64))])
    lower = _pack(values & np.uint64((1 << low) - 1), low)
    head = np.array([n, low, len(upper), len(ones), len(lower)], np.int64)
    return head.tobytes() + upper.tobytes() + ones.astype(np.int64).tobytes() + lower.tobytes()


class EliasFano:
    """Reads a code from a buffer; all methods take and give arrays of positions."""

    def __init__(self, buffer, at: int = 0):
        self.n, self.low, upper, ones, lower = np.frombuffer(buffer, np.int64, 5, at).tolist()
        at += 40
        self.upper = np.frombuffer(buffer, np.uint8, upper, at)
        self.words = np.frombuffer(buffer, np.uint64, upper // 8, at).reshape(-1, 8)
        at += upper
        self.ones = np.frombuffer(buffer, np.int64, ones, at)
        at += 8 * ones
        raw = np.frombuffer(buffer, np.uint8, 8 * lower, at)
        # a 64-bit word from every byte on
        self.lower = np.lib.stride_tricks.as_strided(raw[:8].view(np.uint64), shape=(len(raw) - 7,), strides=(1,), writeable=False)
        self.end = at + 8 * lower
        self.zeros = np.arange(len(self.ones)) * _BLOCK - self.ones
        self.mask = np.uint64((1 << self.low) - 1)

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th 1 (0 if ``flip``) of the upper bits."""
        block = np.searchsorted(before, k, "right") - 1
        rest = k - before[block]
        words = self.words[block]
        if flip:
            words = ~words
        total = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        word = (total <= rest[:, None]).sum(1)
        rows = np.arange(len(k))
        rest = rest - np.where(word > 0, total[rows, np.maximum(word - 1, 0)], 0)
        octets = np.ascontiguousarray(words[rows, word]).view(np.uint8).reshape(-1, 8)
        total = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.int64)
        octet = (total <= rest[:, None]).sum(1)
        rest = rest - np.where(octet > 0, total[rows, np.maximum(octet - 1, 0)], 0)
        return block * _BLOCK + word * 64 + octet * 8 + _IN_BYTE[octets[rows, octet], rest]

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        return self.lower[bit >> 3] >> (bit & 7).astype(np.uint64) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (self._select(i, self.ones, False) - i).astype(np.uint64)
        return high << np.uint64(self.low) | self.low_bits(i)

    def find(self, value: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | None = None) -> np.ndarray:
        """First position in [lo, hi) of each value, or -1: a successor search that starts at the value's own high part."""
        out = np.full(len(value), -1, np.int64)
        if not self.n or not len(value):
            return out
        lo = np.broadcast_to(np.asarray(lo, np.int64), value.shape)
        hi = np.broadcast_to(np.asarray(self.n if hi is None else hi, np.int64), value.shape)
        bucket = (value >> np.uint64(self.low)).astype(np.int64)
        last = len(self.upper) * 8 - int(self.ones[-1]) - 1
        live = np.flatnonzero((lo < hi) & (bucket >= 0) & (bucket <= last))
        bucket = bucket[live]
        first = np.zeros(len(live), np.int64)
        later = bucket > 0
        first[later] = self._select(bucket[later] - 1, self.zeros, True) + 1 - bucket[later]
        after = self._select(bucket, self.zeros, True) - bucket
        # within a high part the low parts are sorted: halve what lies in [lo, hi)
        a, b = np.maximum(first, lo[live]), np.minimum(after, hi[live])
        want = value[live] & self.mask
        end = b.copy()
        go = np.flatnonzero(a < b)
        while len(go):
            middle = (a[go] + b[go]) >> 1
            below = self.low_bits(middle) < want[go]
            a[go], b[go] = np.where(below, middle + 1, a[go]), np.where(below, b[go], middle)
            go = go[a[go] < b[go]]
        hit = np.flatnonzero(a < end)
        hit = hit[self.low_bits(a[hit]) == want[hit]]
        out[live[hit]] = a[hit]
        return out
