"""Vectorised word handling on the byte buffers of Arrow string columns.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which for UTF-8 text equals the
pattern ``[^\\x20\\x09-\\x0D]+``.  Nulls count as empty texts.  All temporaries per byte are built over
segments of about ``SEGMENT`` bytes, cut between words, so one very long text needs no more memory
per byte than many short ones.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 19
BATCH_BYTES = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> _U(31))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


def _byte_codes(fold: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x632BE59BD9B4E019))
    if fold:
        codes[65:91] = codes[97:123]
    return codes


_CODES = {fold: _byte_codes(fold) for fold in (False, True)}
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n + 1:
        with np.errstate(over="ignore"):
            for name, step in (("up", _BASE), ("down", _INVERSE)):
                _powers[name] = np.concatenate([[_U(1)], np.cumprod(np.full(n, step, dtype=np.uint64))])
    return _powers["up"], _powers["down"]


def release() -> None:
    """Give freed memory back to the system, so that a worker between two tasks holds little of it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``most`` bytes of text (a longer single text stays whole)."""
    index = batch.schema.get_field_index(column)
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)
    release()


@dataclass
class Words:
    """data: the bytes of all texts; offsets: of the rows in data; starts, ends: of the words; rows: word range of each row."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def hashes(self, fold: bool = True) -> np.ndarray:
        """64-bit hash of each word; ``fold`` lower-cases A-Z."""
        out, n = np.empty(len(self.starts), dtype=np.uint64), len(self.starts)
        codes, at = _CODES[fold], 0
        while at < n:
            stop = int(np.searchsorted(self.ends, self.starts[at] + SEGMENT, side="right"))
            stop = max(stop, at + 1)
            lo, hi = int(self.starts[at]), int(self.ends[stop - 1])
            up, down = _power_tables(max(hi - lo, SEGMENT))
            with np.errstate(over="ignore"):
                total = np.empty(hi - lo + 1, dtype=np.uint64)
                total[0] = 0
                np.cumsum(codes[self.data[lo:hi]] * up[: hi - lo], out=total[1:])
                first, last = self.starts[at:stop] - lo, self.ends[at:stop] - lo
                out[at:stop] = mix((total[last] - total[first]) * down[first])
            at = stop
        return out

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def row_sums(self, table: np.ndarray) -> np.ndarray:
        """Per row, how many bytes the boolean ``table`` of 256 entries marks."""
        return sums_between(table, self.data, self.offsets)


def sums_between(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(int(np.searchsorted(offsets, offsets[at] + SEGMENT, side="right")) - 1, at + 1)
        lo, hi = int(offsets[at]), int(offsets[stop])
        if hi > lo:
            total = np.concatenate([[0], np.cumsum(table[data[lo:hi]], dtype=np.int64)])
            out[at:stop] = np.diff(total[offsets[at : stop + 1] - lo])
        at = stop
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column, nulls as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array) -> Words:
    data, offsets = buffers(column)
    space = _SPACE[data]
    begin = ~space
    finish = begin.copy()
    if len(data):
        firsts = offsets[:-1][offsets[:-1] < len(data)]
        lasts = offsets[1:][offsets[1:] > 0] - 1
        begin[1:] &= space[:-1]
        begin[firsts] = ~space[firsts]
        finish[:-1] &= space[1:]
        finish[lasts] = ~space[lasts]
    starts = np.flatnonzero(begin)
    return Words(data, offsets, starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets))


def window_hashes(h: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words within rows, and the window range of each row.

    A row with words but fewer than ``width`` has one window, the whole row.
    """
    counts = np.diff(rows)
    full = np.maximum(counts - width + 1, 0)
    n = np.where((counts > 0) & (full == 0), 1, full)
    ptr = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(rows[:-1] - ptr[:-1], n) + np.arange(ptr[-1])
    size = np.repeat(np.minimum(counts, width), n)
    out = np.zeros(ptr[-1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            inside = size > i
            at = np.where(inside, first + i, 0)
            out = np.where(inside, mix(out * _U(0x8CB92BA72F3D8DD7) + h[at] + _U(i + 1)), out) if len(h) else out
    return out, ptr
