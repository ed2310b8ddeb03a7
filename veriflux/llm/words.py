"""Vectorised text helpers: every function works on one flat byte buffer that holds many documents.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
Hashes are polynomials modulo 2**64 over random byte values, so that the hash of any span follows from two prefix
sums. They depend on nothing but the bytes and are the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # documents are hashed in chunks of this size; a longer document is a chunk of its own
SPACES = b" \t\n\x0b\x0c\r"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of an odd number and of its inverse, modulo 2**64; they grow when a longer text comes."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, CHUNK_BYTES)
            self.up, self.down = (self._row(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        row = np.full(n, base, np.uint64)
        row[0] = 1
        return np.multiply.accumulate(row)


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BYTES = Powers(0x2545F4914F6CDD1D)
_WORDS = (Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95))


def span_sums(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers: hash of [s, e) = (sums[e] - sums[s]) * down[s]."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums, down = span_sums(BYTE_VALUES[data], BYTES)
    return mix((sums[ends] - sums[starts]) * down[starts])


def window_hashes(words: np.ndarray, at: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hashes of the windows of `width` words that start at the given word numbers."""
    sums, down = span_sums(words, _WORDS[which])
    return mix((sums[at + width] - sums[at]) * down[at])


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Texts:
    """A chunk of documents as words. first: the number of its first document; doc: word offsets of its documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, lower: bool) -> None:
        self.first, self.offsets = first, offsets
        self.data = LOWER[data] if lower else data
        inside = ~_IS_SPACE[self.data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = ~inside[:-1] | ~inside[1:]
        edge[offsets] = True
        self.starts = np.flatnonzero(inside & edge[:-1])
        self.ends = np.flatnonzero(inside & edge[1:]) + 1
        self.doc = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def owners(self) -> tuple[np.ndarray, np.ndarray]:
        """Per word: document within the chunk, position within the document."""
        n = np.diff(self.doc)
        owner = np.repeat(np.arange(len(n)), n)
        return owner, np.arange(len(self.starts)) - self.doc[owner]

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words, each followed by one blank; where each begins; where each document begins, with the end."""
        size = self.ends - self.starts + 1
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        out = np.full(total, 32, np.uint8)
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        filled = np.ones(total, bool)
        filled[stop - 1] = False
        out[filled] = self.data[np.cumsum(inside[:-1]) > 0]
        begins = np.concatenate(([0], stop))
        return out, begins[:-1], begins[self.doc]

    def words_of(self, k: int) -> list[bytes]:
        return self.data[self.offsets[k] : self.offsets[k + 1]].tobytes().split()


def chunks(column, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    data, offsets = flat(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, lower)
        first = last


def give_back() -> None:
    """Returns memory that is free to the machine: workers are used again, also by stages that need much more or less."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal values, and the length at the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values, kind="stable")
    return values[runs(values)[:-1]]
