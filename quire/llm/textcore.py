"""Vectorised text primitives over Arrow batches: word boundaries, 64-bit word hashes, shingles and content keys.

All of them work on the UTF-8 buffer of a batch, in slices of bounded bytes, so a task's memory follows the slice and
the longest single text rather than the batch. Hashes depend on fixed constants only: every executor gets the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 256 << 10
_RNG = np.random.Generator(np.random.PCG64(20240607))
_RANDOM = _RNG.integers(1, 2**64 - 1, size=1024, dtype=np.uint64) | np.uint64(1)
_BASE = _RNG.integers(1, 2**64 - 1, size=8, dtype=np.uint64) | np.uint64(1)
_pow: dict[int, np.ndarray] = {}


def fmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves about half of the output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, k: int = 0) -> np.ndarray:
    """The first n powers of base k, modulo 2**64."""
    have = _pow.get(k)
    if have is None or len(have) < n:
        out = np.full(max(n, 4096), _BASE[k], dtype=np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= 1 << 20:
            _pow[k] = have
    return have[:n]


def byte_table(separators: bytes, fold: bool = True) -> np.ndarray:
    """A random odd number for each byte, 0 for separators; with fold, A-Z count as a-z."""
    table = _RANDOM[:256].copy()
    if fold:
        table[65:91] = table[97:123]
    table[np.frombuffer(separators, dtype=np.uint8)] = 0
    return table


#: Words are what stands between ASCII white space.
SPACE_TABLE = byte_table(b"\x20\t\n\x0b\x0c\r")
#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
ALNUM_TABLE = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


def slices(bounds: np.ndarray, most: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of about most bytes and at most so many rows; at least one row each, and no row twice."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = min(max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, side="right")) - 1), lo + rows, n)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts data[bounds[i]:bounds[i + 1]]: each word's start (from bounds[0]), its text's number and its hash."""
    base, d = int(bounds[0]), data[int(bounds[0]) : int(bounds[-1])]
    t = table[d]
    inside = t != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = bounds[:-1] - base
    heads = heads[heads < len(d)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    place = np.arange(len(d)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    place[~inside] = 0
    hashes = fmix(np.add.reduceat(t * powers(int(place.max()) + 1)[place], starts))
    return starts, np.searchsorted(bounds - base, starts, side="right") - 1, hashes


def shingles(owner: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of each run of k words; a text of fewer words has its whole sequence as one."""
    n = len(hashes)
    out_h, out_o = [], []
    if n >= k:
        same = owner[: n - k + 1] == owner[k - 1 :]
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += hashes[j : n - k + 1 + j] * _RANDOM[300 + j]
        out_h.append(fmix(total[same]))
        out_o.append(owner[: n - k + 1][same])
    if n:
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        count = np.diff(np.r_[head, n])
        for h, c in zip(head[count < k], count[count < k], strict=True):
            total = np.zeros(1, np.uint64)
            for j in range(c):
                total += hashes[h + j : h + j + 1] * _RANDOM[300 + j]
            out_h.append(fmix(total + _RANDOM[400 + c]))
            out_o.append(owner[h : h + 1])
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_h), np.concatenate(out_o)


def distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, hash) pairs, ordered by both."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return o[new], h[new]


def sequence_keys(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each text's whole word sequence."""
    out = np.zeros((2, n), np.uint64)
    if len(hashes):
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        place = np.arange(len(hashes)) - np.repeat(head, np.diff(np.r_[head, len(hashes)]))
        for k in (1, 2):
            out[k - 1, owner[head]] = fmix(np.add.reduceat(hashes * powers(int(place.max()) + 1, k)[place], head))
    return out[0], out[1]


def binary_rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow binary column: the values' bytes, cut into counts[i] values a row."""
    values = np.ascontiguousarray(values)
    ends = np.r_[0, np.cumsum(counts)].astype(np.int64) * values.itemsize
    if ends[-1] >= 2**31:
        raise ValueError("a batch of over 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])
