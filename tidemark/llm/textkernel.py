"""Vectorised word splitting and hashing over Arrow string buffers.

Everything here works on the UTF-8 bytes of a column without building Python
strings.  Word classes are byte classes, so multi-byte characters are either
word bytes or not, never split.  Temporaries are bounded by ``BLOCK`` bytes of
text; what is returned grows with the number of words.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


def splitmix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` reproducible 64-bit numbers."""
    with np.errstate(over="ignore"):
        return splitmix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_P) + np.uint64(seed & MASK))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


@functools.lru_cache(1)
def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse: one pair for all byte classes of a worker."""
    return _powers(_P, n), _powers(_P_INV, n)


class ByteClass:
    """Which bytes make words, and whether A-Z count as a-z."""

    def __init__(self, word_bytes: np.ndarray, lower: bool):
        self.is_word = word_bytes.astype(bool)
        values = stream(0x5EED, 256)
        if lower:
            values[65:91] = values[97:123]
        self.values = np.where(self.is_word, values, np.uint64(0))

    def powers(self) -> tuple[np.ndarray, np.ndarray]:
        return _power_tables(BLOCK + 1)


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Words [^\x20\x09-\x0D]+, with and without lower-casing A-Z.
SPACED = ByteClass(~_bytes((0x20, 0x20), (0x09, 0x0D)), lower=True)
SPACED_EXACT = ByteClass(~_bytes((0x20, 0x20), (0x09, 0x0D)), lower=False)
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALNUM = ByteClass(_bytes((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)), lower=True)


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not (large or pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column, large = column.cast(pa.large_string()), True
    _, raw, data = column.buffers()
    if raw is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(raw, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row stands alone."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: ByteClass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = kind.is_word[data]
    first = np.empty(len(data), bool)
    first[0] = inside[0]
    np.logical_and(inside[1:], ~inside[:-1], out=first[1:])
    last = np.empty(len(data), bool)
    last[-1] = inside[-1]
    np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: ByteClass) -> np.ndarray:
    """A 64-bit hash of each word's bytes (lower-cased if the class says so)."""
    out = np.empty(len(start), np.uint64)
    power, inverse = kind.powers()
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            base = start[at]
            to = int(np.searchsorted(end, base + BLOCK, side="right"))
            if to <= at:  # one word longer than a block
                out[at], at = _long_word(data[start[at] : end[at]], kind), at + 1
                continue
            part = data[base : end[to - 1]]
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(kind.values[part] * power[: len(part)], out=sums[1:])
            s, e = start[at:to] - base, end[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            at = to
    return splitmix(out)


def _long_word(part: np.ndarray, kind: ByteClass) -> int:
    power, _ = kind.powers()
    total, scale = 0, 1
    with np.errstate(over="ignore"):
        for i in range(0, len(part), BLOCK):
            piece = part[i : i + BLOCK]
            total = (total + int(np.sum(kind.values[piece] * power[: len(piece)], dtype=np.uint64)) * scale) & MASK
            scale = scale * pow(_P, len(piece), 1 << 64) & MASK
    return (total + len(part) * 0xD6E8FEB86659FD93) & MASK


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one row; a shorter row gives one window, an empty row none."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    with np.errstate(over="ignore"):
        mixed = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            mixed = mixed * np.uint64(0xA0761D6478BD642F) + words[j : n - k + 1 + j]
        return splitmix(mixed + np.uint64(k))


class HashTable:
    """64-bit hash -> number, looked up for whole arrays at once (open addressing, linear probing)."""

    def __init__(self, bits: int = 16):
        self._allot(bits)

    def _allot(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int64)
        self.count = 0

    @staticmethod
    def _safe(hashes: np.ndarray) -> np.ndarray:
        return np.where(hashes == 0, np.uint64(1), hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        hashes = self._safe(hashes)
        at = hashes & self.mask
        seen = self.keys[at]
        out = np.where(seen == hashes, self.values[at], -1)
        going = np.flatnonzero((seen != hashes) & (seen != 0))
        at = at[going]
        while len(going):
            at = (at + np.uint64(1)) & self.mask
            seen, wanted = self.keys[at], hashes[going]
            hit = seen == wanted
            out[going[hit]] = self.values[at[hit]]
            more = ~hit & (seen != 0)
            going, at = going[more], at[more]
        return out

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct hashes that are not in the table."""
        if 2 * (self.count + len(hashes)) > len(self.keys):
            used = np.flatnonzero(self.keys)
            old_keys, old_values = self.keys[used], self.values[used]
            self._allot(max(16, int(4 * (len(used) + len(hashes))).bit_length()))
            self.add(old_keys, old_values)
        hashes, values = self._safe(hashes), np.asarray(values)
        self.count += len(hashes)
        at = hashes & self.mask
        while len(hashes):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]  # of several at one place the last stays
            won = free & (self.keys[at] == hashes)
            self.values[at[won]] = values[won]
            hashes, values, at = hashes[~won], values[~won], (at[~won] + np.uint64(1)) & self.mask
