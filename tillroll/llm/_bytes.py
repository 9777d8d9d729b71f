"""Vectorised helpers over the raw UTF-8 bytes of an Arrow text column.

Everything works on the column's buffers: no Python string is built per word or
per position.  Hashes are 64-bit, seeded by fixed constants, so that every
executor computes the same values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)
#: Bytes taken at once; bounds the working arrays (about 100 bytes for each).
SLICE_BYTES = 1 << 20


def is_space_table() -> np.ndarray:
    """True at the six ASCII white-space bytes [\\x20\\x09-\\x0D]."""
    t = np.zeros(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return t


SPACE = is_space_table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: two rounds of multiply and xor-shift."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random-looking value for each byte; position is weighted by powers of BASE.
BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * ODD)
BASE = U64(0x5851F42D4C957F2D)  # odd, so it has an inverse modulo 2**64
BASE_INV = U64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


_POW: dict[str, np.ndarray] = {}


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _POW or len(_POW[name]) < n:
        _POW[name] = powers(base, max(n, SLICE_BYTES + 1))
    return _POW[name][:n]


class RangeHash:
    """64-bit hashes of any [start, end) of one byte array, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, U64)
        np.cumsum(BYTE_VALUE[data] * _table("pow", BASE, n), out=self.prefix[1:])
        self.inverse = _table("inv", BASE_INV, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(h + (np.asarray(end) - start).astype(U64) * ODD)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets, data


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Row ranges (a, b) of at most ``most`` bytes, a single longer row alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, b
        a = b


def word_bounds(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a row's start also begins a word."""
    ink = ~SPACE[data]
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[row_starts[row_starts < n]] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | first[:n]))
    after = np.zeros(n, bool)
    after[:-1] = ink[1:] & ~first[1:n]
    ends = np.flatnonzero(ink & ~after) + 1
    return starts, ends


def sequence_hashes(items: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive items (len - width + 1 of them)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for k in range(width):
        total = total * BASE + items[k:k + n]
    return mix(total)


def distinct(items: np.ndarray) -> np.ndarray:
    """Sorted distinct values (np.unique hashes integers, which is slower here)."""
    items = np.sort(items)
    if len(items) < 2:
        return items
    new = np.ones(len(items), bool)
    np.not_equal(items[1:], items[:-1], out=new[1:])
    return items[new]


def row_shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5, lower: bool = True):
    """Yield, for each row, the hashes of its word windows in reading order.

    A row of fewer than ``width`` words gives one hash of its whole sequence, a
    row without words an empty array.  Also yields the row's word count.
    """
    for a, b in slices(offsets):
        base = offsets[a]
        part = data[base:offsets[b]]
        if lower:
            part = LOWER[part]
        local = offsets[a:b + 1] - base
        starts, ends = word_bounds(part, local[:-1])
        words = RangeHash(part)(starts, ends) if len(starts) else np.zeros(0, U64)
        windows = sequence_hashes(words, width)
        cuts = np.searchsorted(starts, local)
        for i in range(b - a):
            lo, hi = int(cuts[i]), int(cuts[i + 1])
            n = hi - lo
            if n >= width:
                yield windows[lo:hi - width + 1], n
            elif n:
                yield sequence_hashes(words[lo:hi], n) + U64(n), n
            else:
                yield np.zeros(0, U64), 0
