"""Vectorised text helpers that run inside Arrow batches.

Texts stay in their Arrow buffers; words, word hashes and shingles are computed
with numpy over runs of whole rows of about ``CHUNK_BYTES`` bytes, so memory
stays bounded by that size or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# ASCII letters, digits and every byte of a non-ASCII character count as part of a bare word.
BARE = np.zeros(256, bool)
BARE[48:58] = BARE[65:91] = BARE[97:123] = BARE[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int, which: str) -> np.ndarray:
    if len(_powers[which]) < n:
        step = _BASE if which == "up" else np.uint64(pow(int(_BASE), -1, 2**64))
        f = np.full(max(n, CHUNK_BYTES + 1), step, np.uint64)
        f[0] = 1
        _powers[which] = np.multiply.accumulate(f)
    return _powers[which][:n]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, equal for equal spans wherever they lie."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * _power(len(data), "up"), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(len(data) + 1, "down")[starts]
               + (ends - starts).astype(np.uint64))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def runs(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive whole rows of about ``limit`` bytes: (first row, bytes, offsets)."""
    data, off = string_buffers(column)
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, data[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches of True bytes that stay within one row: (starts, ends, first span of each row)."""
    before = np.empty(len(inside), bool)
    after = np.empty(len(inside), bool)
    if len(inside):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(inside))]
        before[edge] = False
        after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, bare: bool = False):
    """Hashes of the words, ASCII case folded, and the first word of each row.

    Words are separated by ASCII white space, or (``bare``) by anything but
    letters and digits.
    """
    data = LOWER[data]
    starts, ends, first = spans_of(BARE[data] if bare else ~SPACE[data], offsets)
    return span_hash(data, starts, ends), first


def shingles(word: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of a row, and the first shingle of each row.

    A row of 1 to k - 1 words has one shingle, of all its words.
    """
    n = len(word)
    count = np.diff(first)
    own = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    start = np.concatenate([[0], np.cumsum(own)])
    at = np.arange(start[-1]) + np.repeat(first[:-1] - start[:-1], own)
    size = np.repeat(np.minimum(count, k), own)
    out = size.astype(np.uint64)
    for j in range(k):
        step = word[np.minimum(at + j, n - 1)] if n else word
        out = np.where(j < size, (out ^ step) * (BYTE_CODE[j] | np.uint64(1)) + (out >> np.uint64(29)), out)
    return mix(out), start


def occurrence(values: np.ndarray) -> np.ndarray:
    """0 for the first time a value appears, 1 for the second, and so on."""
    order = np.argsort(values, kind="stable")
    v = values[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    at = np.arange(len(v))
    out = np.empty(len(v), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each value, distinct values in order of appearance), by hashing."""
    if not len(values):
        return np.zeros(0, np.int64), values
    found = pa.array(signed(values)).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), unsigned(found.dictionary.to_numpy())


def firsts(codes: np.ndarray, n: int) -> np.ndarray:
    """Place where each code appears first."""
    out = np.zeros(n, np.int64)
    out[codes[::-1]] = np.arange(len(codes))[::-1]
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


_SCATTER = np.uint64(0x9E3779B97F4A7C15)


def probe_table(keys: np.ndarray) -> np.ndarray:
    """Open-addressing table of distinct keys >= 0: rows (key, place in ``keys``), -1 where empty; at most a quarter full."""
    bits = max(4, int(4 * max(1, len(keys)) - 1).bit_length())
    out = np.full((1 << bits, 2), -1, np.int64)
    left = np.arange(len(keys))
    slot = (keys.astype(np.uint64) * _SCATTER >> np.uint64(64 - bits)).astype(np.int64)
    while len(left):
        free = out[slot[left], 0] < 0
        _, one = np.unique(slot[left[free]], return_index=True)
        put = left[free][one]
        out[slot[put], 0], out[slot[put], 1] = keys[put], put
        left = left[out[slot[left], 0] != keys[left]]
        slot[left] = (slot[left] + 1) & ((1 << bits) - 1)
    return out


def probe(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, or -1."""
    bits = len(table).bit_length() - 1
    slot = (keys.astype(np.uint64) * _SCATTER >> np.uint64(64 - bits)).astype(np.int64)
    found = table[slot, 0]
    out = np.where(found == keys, table[slot, 1], -1)
    left = np.flatnonzero((found != keys) & (found >= 0))
    while len(left):
        slot[left] = (slot[left] + 1) & (len(table) - 1)
        found = table[slot[left], 0]
        hit = found == keys[left]
        out[left[hit]] = table[slot[left[hit]], 1]
        left = left[~hit & (found >= 0)]
    return out
