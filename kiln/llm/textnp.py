"""Words and shingles of Arrow text columns as numpy arrays (no per-word Python).

Texts of an Arrow batch lie end to end in one UTF-8 buffer.  Words are found
by byte class; a word's hash is the difference of two prefix sums of
``random[byte] * BASE**place``, divided by the power at its start, so equal
words hash alike wherever they stand.  Sums are modulo 2**64 and mixed
afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

__all__ = ["buffer_of", "slices", "mix", "byte_sums", "span_hash", "word_table", "shingle_hashes"]

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
#: The same with A-Z as a-z.
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes (a longer row stands alone)."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(rows, max(start + 1, stop))
        yield start, stop
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * U(pow(base, done, 1 << 64))
        done += more
    return out[:n]


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n``; kept for the next call while they are small."""
    have = _cache.get(0)
    if have is None or len(have[0]) < n:
        have = (_powers(BASE, n), _powers(INVERSE, n))
        if n <= 1 << 23:
            _cache[0] = have
    return have[0][:n], have[1][:n]


def byte_sums(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Prefix sums of the bytes' random numbers times the power of their place."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unmixed hash of data[start:end] for arrays of starts and ends."""
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def word_table(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, ...]:
    """(hash, start, end, row) of each word; words end at white space and at the ends of rows."""
    inside = ~IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    before[borders] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[borders - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = byte_sums(data, LOWER if lower else BYTE)
    hashes = mix(span_hash(sums, starts, ends) + (ends - starts).astype(np.uint64))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    return hashes, starts, ends, rows


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of each run of ``size`` words (fewer words: of all of them as one)."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * U(BASE) + words[k:k + n])
    return out
