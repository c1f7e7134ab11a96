"""Vectorised work on Arrow string columns: words, lines, hashes, windows.

Texts stay UTF-8 bytes in one array per slice; a slice holds whole texts of up
to ``SLICE_BYTES`` together, or one longer text. Nothing here touches Spark.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts worked on at a time, in bytes.
SLICE_BYTES = 2 << 20

U = np.uint64
#: Odd multipliers of the mixing steps.
M1, M2, M3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xFF51AFD7ED558CCD)
#: Spans of more than 8 * ROUNDS bytes are hashed one by one.
ROUNDS = 40

IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], U)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[offs[0]:offs[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def release() -> None:
    """Gives freed memory back to the system: Python workers are reused, and
    what one operator leaves would count against the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(table: pa.RecordBatch | pa.Table, text: str = "text", limit: int = SLICE_BYTES) -> Iterator:
    """Consecutive row slices whose texts hold at most ``limit`` bytes, or one row."""
    _, offs = text_bytes(table.column(text))
    row, n = 0, len(offs) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, "right")) - 1)
        yield table.slice(row, end - row)
        row = end
    release()


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True within the texts: starts, ends, and the first run of each text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    edges = offs[(offs > 0) & (offs < n)]
    before[edges] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offs)


def words(data: np.ndarray, offs: np.ndarray):
    """Starts and ends of all words, and the index of each text's first word."""
    return spans(IS_WORD[data], offs)


def mix(h: np.ndarray) -> np.ndarray:
    h = h * M3
    h ^= h >> U(32)
    h *= M2
    h ^= h >> U(29)
    return h


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes a step.

    ``lower`` takes A-Z as a-z.
    """
    if lower:
        upper = (data >= 65) & (data <= 90)
        data = np.where(upper, data | 32, data).astype(np.uint8)
    pad = np.zeros(len(data) + 8, np.uint8)
    pad[:len(data)] = data
    view = np.ndarray(len(data) + 1, "<u8", buffer=pad, strides=(1,))
    left = ends - starts
    h = mix((left.astype(U) + U(1)) * M1 ^ (view[starts] & _MASK[np.minimum(left, 8)]))
    live = np.flatnonzero(left > 8)
    at, left = starts[live] + 8, left[live] - 8
    for _ in range(ROUNDS):
        if not len(live):
            return h
        h[live] = mix(h[live] * M1 ^ (view[at] & _MASK[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in live:
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def windows(h: np.ndarray, k: int, by: np.uint64 = M1) -> np.ndarray:
    """A hash of every ``k`` consecutive entries of ``h`` (len(h) - k + 1 of them)."""
    n = max(len(h) - k + 1, 0)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= by
        acc += h[j:j + n]
    return mix(acc ^ U(k))


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word, from the index of each text's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole(first: np.ndarray, k: int) -> np.ndarray:
    """Which windows of ``k`` words lie within one text."""
    n = max(int(first[-1]) - k + 1, 0)
    return np.arange(n) + k <= np.repeat(first[1:], np.diff(first))[:n]


def per_text(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many True each text has."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = np.cumsum(lengths)
    n = int(total[-1]) if len(total) else 0
    return np.arange(n) + np.repeat(starts - (total - lengths), lengths)


def binary_rows(values: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of values[offs[i]:offs[i + 1]]."""
    width = values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offs) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offs * width, np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())
