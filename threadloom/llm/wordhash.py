"""Vectorised words, word hashes and window hashes over Arrow string columns.

A word is a run of bytes other than space and 0x09-0x0D. All of those are ASCII, so UTF-8 bytes can be cut without
decoding. Hashes are 64 bits: a word's is a polynomial over a random byte table, a window's a polynomial over its
words' hashes, both computed from prefix sums modulo 2**64 and then mixed. Work goes by groups of whole documents of
about two megabytes, so memory follows the longest document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 2 << 20
_rng = np.random.Generator(np.random.PCG64(20240517))
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BASE = int(0x9E3779B97F4A7C15)
_BASE2 = int(0xD1342543DE82EF95)


class _Powers:
    """base**k and its inverse modulo 2**64, for as many k as were ever asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            self.up, self.down = (self._table(b, size) for b in (self.base, self.inverse))
        return self.up, self.down

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        out = np.ones(size, dtype=np.uint64)
        k = 1
        while k < size:
            out[k : 2 * k] = out[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        return out


_BYTES, _WORDS = _Powers(_BASE), _Powers(_BASE2)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits under which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Group:
    """Some whole documents: rows first..last-1 of the batch."""

    first: int
    last: int
    data: np.ndarray  # their bytes
    offsets: np.ndarray  # where each document starts in data, and the end
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    word_of: np.ndarray  # the first word of each document, and the number of words

    def counts(self) -> np.ndarray:
        return np.diff(self.word_of)

    def hashes(self, fold: bool = False) -> np.ndarray:
        """One 64-bit hash a word; with fold, A-Z count as a-z."""
        n = len(self.data)
        up, down = _BYTES.upto(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_FOLDED if fold else _TABLE)[self.data] * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they all lie in its document."""
        n = len(hashes)
        m = max(0, n - k + 1)
        up, down = _WORDS.upto(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:n], out=total[1:])
        out = mix((total[k:] - total[: n + 1 - k]) * down[:m]) if m else np.zeros(0, dtype=np.uint64)
        fits = np.arange(m) + k <= np.repeat(self.word_of[1:], self.counts())[:m]
        return out, fits


def span_hash(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the words first..last-1, for arrays of spans."""
    n = len(hashes)
    up, down = _WORDS.upto(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=total[1:])
    return mix((total[last] - total[first]) * down[first])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n+1 offsets into them; nulls have no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    all_bytes = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return all_bytes[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(column: pa.Array, most: int = GROUP_BYTES, rows: int = 1 << 30) -> Iterator[Group]:
    """Cuts a text column into groups of whole documents of about `most` bytes (a longer document is one alone)."""
    data, offsets = text_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        last = min(last, first + rows, n)
        yield split(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last)
        first = last


def split(data: np.ndarray, offsets: np.ndarray, first: int = 0, last: int = 1) -> Group:
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    begins[cut] = inside[1:-1][cut]  # a word never runs over from one document into the next
    ends[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Group(first, last, data, offsets, start, end, np.searchsorted(start, offsets))
