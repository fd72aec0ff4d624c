"""Words of whole texts as 64-bit hashes, computed for a slice of an Arrow batch at once.

Executors hand over Arrow batches; a batch is cut into slices of half a megabyte, so that
the working arrays stay small whatever the batch holds. A single longer text is a slice of
its own. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_ROOT = 0x9E3779B97F4A7C15


@dataclass
class Slice:
    """Rows ``start`` to ``stop`` of a batch: their bytes, and where each row's begin."""

    start: int
    stop: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_rows(self) -> int:
        return self.stop - self.start


@dataclass
class Words:
    """Words of a slice in order: hash, row within the slice, first and last-plus-one byte."""

    hashes: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a string or binary column in slices of at most ``limit`` bytes or one row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield Slice(start, stop, data[offsets[start]:offsets[stop]],
                    offsets[start:stop + 1] - offsets[start])
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the usual finaliser with two multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    root = np.uint64(0xD1342543DE82EF95)
    inverse = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
    up, down = np.full(n, root), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd root and of its inverse modulo 2**64, at least ``n`` of each."""
    size = 1 << max(16, int(n).bit_length())
    return _powers(size)


@lru_cache(maxsize=4)
def byte_values(fold: bool) -> np.ndarray:
    """A random 64-bit value per byte; ``fold`` gives A-Z the values of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ROOT))
    if fold:
        values = values.copy()
        values[65:91] = values[97:123]
    return values


def prefix_sums(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """Sums of byte value times root power: any stretch's hash is a difference of two."""
    out = np.zeros(len(data) + 1, np.uint64)
    up, _ = powers(len(data) + 1)
    np.cumsum(byte_values(fold)[data] * up[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def stretch_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte stretches [begin, end); equal bytes give equal hashes anywhere."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true bytes; a run never crosses into another row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def rows_of(begin: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, begin, "right") - 1


def words(part: Slice, fold: bool = False, inside: np.ndarray | None = None) -> Words:
    """Words of a slice: runs of bytes other than white space, or of ``inside`` bytes.

    ``fold`` hashes A-Z as a-z.
    """
    inside = ~WHITE if inside is None else inside
    begin, end = runs(inside[part.data], part.offsets)
    sums = prefix_sums(part.data, fold)
    return Words(stretch_hashes(sums, begin, end), rows_of(begin, part.offsets), begin, end)


def shingles(found: Words, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and their rows.

    A row with fewer words, but at least one, has one shingle of all its words.
    """
    h, row = found.hashes, found.row
    n = len(h)
    base = np.uint64(0xA24BAED4963EE407)
    counts = np.bincount(row, minlength=n_rows)
    out, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= size:
        acc = h[:n - size + 1].copy()
        for k in range(1, size):
            acc = acc * base + h[k:n - size + 1 + k]
        whole = row[:n - size + 1] == row[size - 1:]
        out, rows = mix(acc[whole]), row[:n - size + 1][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        firsts = np.cumsum(counts) - counts
        extra = []
        for r in short:
            acc = np.uint64(counts[r])
            with np.errstate(over="ignore"):
                for k in range(counts[r]):
                    acc = acc * base + h[firsts[r] + k]
            extra.append(acc)
        out = np.concatenate([out, mix(np.array(extra, np.uint64))])
        rows = np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        out, rows = out[order], rows[order]
    return out, rows
