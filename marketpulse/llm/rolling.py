"""Words and Rabin-Karp hashes of whole Arrow batches, without a loop per word.

A text's bytes are mapped through a table of random 64-bit values and summed
with powers of an odd base (mod 2**64), so a word's hash is a difference of
two prefix sums times an inverse power. Windows of words are hashed the same
way over the words' hashes. Every hash passes a bit mixer at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word characters: anything but ASCII white space; ASCII letters, digits and all others.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, *range(9, 14)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

SLICE_BYTES = 1 << 19


class _Powers:
    def __init__(self, base: int):
        self.base, self.pow, self.inv = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pow) < n:
            size = max(n, 1 << 20)
            for name, base in (("pow", self.base), ("inv", pow(self.base, -1, 2 ** 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.pow[:n], self.inv[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=out[1:])
    return out


@dataclass
class Words:
    """The words of some consecutive rows: byte ranges in ``data``, hashes,
    and for each row the index of its first word (one more for the end)."""
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of each window of k words of one row."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        power, inverse = _WORD_POWERS.upto(n)
        sums = _sums(self.hash * power)
        left = np.repeat(self.first[1:], self.counts)[: n - k + 1] - np.arange(n - k + 1)
        at = np.flatnonzero(left >= k)
        return at, mix((sums[at + k] - sums[at]) * inverse[at])

    def whole(self, row: np.ndarray) -> np.ndarray:
        """Hash of all words of each of those rows (not empty)."""
        power, inverse = _WORD_POWERS.upto(max(1, len(self.hash)))
        sums = _sums(self.hash * power)
        a, b = self.first[row], self.first[row + 1]
        return mix((sums[b] - sums[a]) * inverse[a])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    column = column.cast(pa.large_string()) if len(column) else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def ranges(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``limit`` bytes, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(offsets: np.ndarray, data: np.ndarray, i: int, j: int,
          kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """The words of rows i to j: the longest runs of ``kind`` bytes."""
    edges = offsets[i: j + 1] - offsets[i]
    b = data[offsets[i]: offsets[j]]
    if lower:
        b = LOWER[b]
    n = len(b)
    inside = kind[b]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    at = edges[:-1][edges[:-1] < n]
    opens[at] = inside[at]
    at = edges[1:][edges[1:] > 0] - 1
    closes[at] = inside[at]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(b, start, end, hash_ranges(b, start, end), np.searchsorted(start, edges))


def hash_ranges(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end."""
    n = len(b)
    power, inverse = _BYTE_POWERS.upto(n + 1)
    sums = _sums(_BYTE[b] * power[:n])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))
