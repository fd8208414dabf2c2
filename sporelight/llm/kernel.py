"""Vectorised byte kernels shared by the corpus operators.

Every function here works on the raw UTF-8 bytes of an Arrow string column
(one uint8 buffer plus document offsets), so no Python string is made for a
document or a word.  All loops are numpy loops over a *slice* of rows whose
bytes are bounded (``SLICE_BYTES``; one longer document forms a slice of its
own), hence memory does not grow with a partition.

Word classes are byte classes: a multi-byte character consists of bytes
>= 0x80 only, so a class that treats all non-ASCII characters alike can be
decided byte by byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
LONG_RUN = 256

_BLOCK = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

#: word bytes of `[^\x20\x09-\x0D]+`
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


class Slice(NamedTuple):
    """Rows ``first`` .. ``first + len(offsets) - 1`` of a record batch."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows, offsets[0] == 0
    null: np.ndarray  # bool by row

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def _string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # pyarrow may give one chunk back
            column = column.chunk(0)
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n, _, _ = len(column), 0, 0
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    _, offsets_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    null = np.asarray(column.is_null()) if column.null_count else np.zeros(n, bool)
    return data, offsets, null


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into runs of rows of at most ``max_bytes`` bytes (a longer row is alone).

    A null row appears as an empty text with its ``null`` flag set."""
    data, offsets, null = _string_buffers(column)
    n, lo = len(null), 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        base = offsets[lo]
        yield Slice(lo, data[base : offsets[hi]], offsets[lo : hi + 1] - base, null[lo:hi])
        lo = hi


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z."""
    return _FOLD[data]


def runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of ``table`` inside each document: starts, ends, and their offsets by document."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Where the state of a run begins, by its length.
_SIZE_STATE = mix(np.arange(1, LONG_RUN + 3))


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each run's bytes (equal bytes: equal hash, wherever they stand).

    A run is taken in blocks of eight bytes, each multiplied into the state; the
    n-th blocks of all runs go together.  Runs of more than ``LONG_RUN`` bytes,
    few in a slice of bounded size, are hashed one by one."""
    size = end - start
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    state = (_SIZE_STATE[np.minimum(size, LONG_RUN + 1)] ^ (words[start] & _FIRST_BYTES[np.minimum(size, 8)])) * _BLOCK
    live, done = np.flatnonzero((size > 8) & (size <= LONG_RUN)), 8
    while len(live):
        now = state[live]
        now ^= now >> np.uint64(32)
        now ^= words[start[live] + done] & _FIRST_BYTES[np.minimum(size[live] - done, 8)]
        now *= _BLOCK
        state[live] = now
        done += 8
        live = live[size[live] > done]
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        state[i] ^= np.uint64(xxhash.xxh3_64_intdigest(np.ascontiguousarray(data[start[i] : end[i]])))
    return mix(state)


def window_hash(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k consecutive words (also across documents; callers mask those)."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += word[i : i + n]
    return mix(out)


def doc_of(row_offsets: np.ndarray) -> np.ndarray:
    """Row number of each element of a CSR layout."""
    return np.repeat(np.arange(len(row_offsets) - 1), np.diff(row_offsets))


def sums_by_doc(values: np.ndarray, row_offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's elements; empty rows give 0."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[row_offsets[1:]] - total[row_offsets[:-1]]


def whole_windows(row_offsets: np.ndarray, k: int, total: int) -> np.ndarray:
    """Mask over window starts (``total - k + 1`` of them): windows that stay in one row."""
    n = max(0, total - k + 1)
    ok = np.ones(n, dtype=bool)
    if k > 1:
        for cut in range(1, k):
            bad = row_offsets[1:-1] - cut
            ok[bad[(bad >= 0) & (bad < n)]] = False
    return ok


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, x >> np.uint32(1) ^ np.uint32(0xEDB88320), x >> np.uint32(1))
    return x.astype(np.uint32)


_CRC = _crc_table()


def crc_begin(n: int) -> np.ndarray:
    """States of n CRC-32 sums of nothing yet."""
    return np.full(n, 0xFFFFFFFF, np.uint32)


def crc_byte(state: np.ndarray, byte: int | np.ndarray) -> np.ndarray:
    """Each sum goes on with one byte."""
    return _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def crc_more(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Each sum goes on with the bytes of its run; runs of more than ``LONG_RUN`` bytes are taken one by one."""
    state, size, done = state.copy(), end - start, 0
    live = np.flatnonzero((size > 0) & (size <= LONG_RUN))
    while len(live):
        state[live] = crc_byte(state[live], data[start[live] + done])
        done += 1
        live = live[size[live] > done]
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        state[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def crc_end(state: np.ndarray) -> np.ndarray:
    """The CRC-32 values, unsigned."""
    return state ^ np.uint32(0xFFFFFFFF)


class Grown:
    """An array that grows at its end; eight spare bytes follow it."""

    def __init__(self, kind: type):
        self._all, self._n = np.zeros(1024, kind), 0

    def __len__(self) -> int:
        return self._n

    def extend(self, more: np.ndarray) -> None:
        need = self._n + len(more) + 8
        if need > len(self._all):
            self._all = np.concatenate([self._all[: self._n], np.zeros(need + len(self._all) - self._n, self._all.dtype)])
        self._all[self._n : self._n + len(more)] = more
        self._n += len(more)

    @property
    def values(self) -> np.ndarray:
        return self._all[: self._n]


def _strided(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on (zeros beyond the end), as numbers."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def same_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each run's bytes equal those of ``other`` from ``at`` on, ``length`` of them."""
    size = end - start
    same = size == length
    a, b, done = _strided(data), _strided(other), 0
    live = np.flatnonzero(same & (size > 0) & (size <= LONG_RUN))
    while len(live):
        equal = ((a[start[live] + done] ^ b[at[live] + done]) & _FIRST_BYTES[np.minimum(size[live] - done, 8)]) == 0
        same[live[~equal]] = False
        done += 8
        live = live[equal & (size[live] > done)]
    for i in np.flatnonzero(same & (size > LONG_RUN)).tolist():
        same[i] = np.array_equal(data[start[i] : end[i]], other[at[i] : at[i] + size[i]])
    return same
