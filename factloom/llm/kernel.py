"""Vectorised text kernels shared by the operators of this subpackage.

Everything works on the UTF-8 buffers of an Arrow string column, a bounded
block of bytes at a time; no Python object is made per word.  A null text is
an empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1


def _give_back() -> None:
    """Unused memory of Arrow's pool and, where there is a way to, of the C library."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a task that gives back what it no longer uses when it ends: the next task has the same Python worker."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return inner


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: The separators of words: \x20 and \x09-\x0D.
SPACE = byte_table(b" \t\n\x0b\x0c\r")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW: np.ndarray | None = None
_INV: np.ndarray | None = None


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if _POW is None or len(_POW) < n:
        size = max(n, _SEGMENT + 1)
        _POW, _INV = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & _M64], dtype=np.uint64))[0])


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        empty: bytes | str = b""
    else:
        empty = ""
    if column.null_count:
        column = pc.fill_null(column, empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if raw[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(raw[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) in blocks of about ``most`` bytes, one row at least."""
    data, offsets = text_buffers(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, n, lo + 65536)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``inside`` bytes that no row boundary crosses: starts, ends, first run of each row."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] |= inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] |= inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets, "left")


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    out = (data - np.uint8(65) < np.uint8(26)).view(np.uint8) << np.uint8(5)
    out += data
    return out


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit content hashes of disjoint ascending byte ranges; an empty range hashes to a constant."""
    out = np.zeros(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _SEGMENT, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        if b > a:
            power, inverse = _tables(b - a + 1)
            value = _lowered(data[a:b]) if lower else data[a:b]
            total = np.zeros(b - a + 1, dtype=np.uint64)
            # No byte of UTF-8 text is 255, so one more fits.
            np.cumsum(np.multiply(value + np.uint8(1), power[: b - a]), out=total[1:])
            s, e = starts[lo:hi] - a, ends[lo:hi] - a
            out[lo:hi] = (total[e] - total[s]) * inverse[s]
        lo = hi
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of a block: byte ranges, hashes, and ``first[row]``, the first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, inside: np.ndarray | None = None):
        self.starts, self.ends, self.first = spans(~SPACE[data] if inside is None else inside, offsets)
        self.hash = hash_spans(data, self.starts, self.ends, lower)
        self.counts = np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order and the first of each row; of fewer words, the whole sequence is one."""
    n = len(words.hash)
    row = words.row
    out = words.hash.copy()
    left = words.first[1:][row] - np.arange(n) if n else np.zeros(0, np.int64)
    for j in range(1, k):
        more = np.flatnonzero(left > j)
        out[more] = mix(out[more] * np.uint64(0x2545F4914F6CDD1D) + words.hash[more + j] + np.uint64(j))
    short = words.counts < k
    keep = np.where(short[row], left == words.counts[row], left >= k) if n else np.zeros(0, bool)
    per_row = np.bincount(row[keep], minlength=len(words.counts)) if n else np.zeros(len(words.counts), np.int64)
    return out[keep], np.concatenate([[0], np.cumsum(per_row)])


def crc32_mod(column: str, m: int):
    """crc32 of an integer column written as decimal text, modulo m (null ids count as the empty text)."""
    from pyspark.sql import functions as F

    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(m)
