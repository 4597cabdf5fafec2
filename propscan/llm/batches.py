"""Flat views of text batches: words, hashes and sums over whole batches with numpy.

Python functions of this subpackage get Arrow batches from Spark and look at the UTF-8 bytes of a
column as one array, in chunks of whole rows, so that no Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

#: The white space that separates words: space and 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Lower-cases A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@cache
def _trim():
    """The C library's call that gives freed memory back to the system; elsewhere it does nothing."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Return memory that this worker has freed: Arrow's pool and the C heap, which keeps what lies below a live object."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def released(run):
    """A function of Arrow batches that gives unused memory back when its task ends, as workers live on."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def released_group(run, least: int = 1 << 20):
    """The same for a function of one group's table; groups below ``least`` bytes leave little behind."""

    def group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            if table.nbytes >= least:
                give_back()

    return group


_R = 0x9E3779B97F4A7C15
_POW = {"r": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (an invertible finaliser of shifts and multiplications)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["r"]) < n:
        for name, base in (("r", _R), ("inv", pow(_R, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps, dtype=np.uint64)
    return _POW["r"][:n], _POW["inv"][:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(buffers[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[off[0] : off[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, row after the last, bytes, offsets)`` of whole rows of about ``size`` bytes."""
    data, off = flat(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def slices(batch: pa.RecordBatch, column: int, size: int = CHUNK_BYTES // 4) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text in ``column``; slicing a slice again changes nothing."""
    _, off = flat(batch.column(column))
    i, n = 0, len(batch)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def word_spans(data: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs without ``space``) and the index of each row's first word."""
    word = ~space[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    at = off[off < len(data)]
    begin[at] = word[at]
    at = off[off > 0] - 1
    end[at] = word[at]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running sum over the batch."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * power[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive word hashes, from each word on; windows run over row ends."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(_R) + words[j : n + j]
    return mix(acc)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
