"""Words and their 64-bit hashes, for whole Arrow columns at once.

Works on the UTF-8 bytes of a string column: a table of 256 entries maps each byte to its folded
value, or to 0 where it separates words. Bytes of non-ASCII characters are all above 0x7F, so ASCII
separators and ASCII case folding need no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20


def byte_table(is_separator) -> np.ndarray:
    """The folding table: A-Z to a-z, 0 for each byte below 0x80 for which ``is_separator(byte)``.

    NUL as part of a word is folded to 0xFF, which UTF-8 never uses.
    """
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[0] = 0xFF
    for byte in range(128):
        if is_separator(byte):
            table[byte] = 0
    return table


#: Words are runs of anything but ASCII white space.
SPACED = byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Words are runs of ASCII letters and digits and of all non-ASCII characters.
ALNUM = byte_table(lambda b: not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, extended on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE_INVERSE)]), dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], dtype=width)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data = data[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """The words of consecutive texts: bounds[i]:bounds[i+1] are those of text i."""

    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    folded: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i]:self.bounds[i + 1]]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal ranges get equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers.upto(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


def hash_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Words of the texts that lie one after the other in ``data``."""
    folded = table[data]
    inside = folded != 0
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        begins[cuts] = inside[cuts]
        last = offsets[1:][offsets[1:] > 0] - 1
        ends[last] = inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(np.searchsorted(starts, offsets), span_hashes(folded, starts, stops), starts, stops, folded)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes, at least one text each."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def words_of(column: pa.Array, table: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first, last, words) for ranges of rows of a string column."""
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        cut = offsets[first:last + 1]
        yield first, last, hash_words(data[cut[0]:cut[-1]], cut - cut[0], table)


def rolling(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside each text, and the bounds of each text's runs."""
    n = np.diff(bounds)
    runs = np.maximum(n - (k - 1), 0)
    run_bounds = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(bounds[:-1] - run_bounds[:-1], runs) + np.arange(run_bounds[-1])
    with np.errstate(over="ignore"):
        value = np.zeros(len(first), np.uint64)
        for j in range(k):
            value = value * _BASE + hashes[first + j]
        return mix(value), run_bounds
