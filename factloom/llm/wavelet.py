"""Token-id output: a wavelet matrix per shard in one compressed file.

The bits of all ids of a shard are kept as succinct planes, the highest bit
first; each plane's order is the stable partition of the one above by its
bit.  A plane is compressed in blocks.  A directory holds each block's place
and the set bits before it, which serves rank and select: access, counting and
occurrence lookup read the directory and the blocks that they touch, nothing
else.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel, ranges, shared, tokens

_MAGIC = b"FLWM0002"
_HEAD = struct.Struct("<8sQI")
#: Bits of a block; decompressed blocks that a reader keeps.
BLOCK, KEPT = 1 << 16, 256
#: A shard is closed at this many ids.
SHARD_TOKENS = 1 << 22


class WaveletMatrix:
    """A matrix over its file's bytes (bytes or a memory map), read block by block; ``touched``: compressed bytes of blocks read so far."""

    def __init__(self, raw):
        self.raw, self.touched = raw, 0
        magic, self.n, self.levels = _HEAD.unpack_from(raw, 0)
        if magic != _MAGIC:
            raise ValueError("not a wavelet shard")
        at, m, blocks = _HEAD.size, self.levels, -(-self.n // BLOCK)
        self.zeros = np.frombuffer(raw, np.uint64, m, at).astype(np.int64)
        at += 8 * m
        #: Set bits of each plane before each block; places of the blocks' bytes.
        self.before = np.frombuffer(raw, np.uint64, m * (blocks + 1), at).reshape(m, blocks + 1).astype(np.int64)
        at += 8 * m * (blocks + 1)
        self.place = np.frombuffer(raw, np.uint64, m * blocks + 1, at).astype(np.int64) + at + 8 * (m * blocks + 1)
        self.blocks = blocks
        self._kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._open = zstandard.ZstdDecompressor()

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        values = np.asarray(values)
        n, most, width = len(values), int(values.max(initial=0)), BLOCK // 8
        now = values.astype(np.uint16 if most < 1 << 16 else np.uint32)
        squeeze = zstandard.ZstdCompressor(level=1)
        zeros, before, body = [], [], []
        for level in reversed(range(max(1, most.bit_length()))):
            bit = (now >> now.dtype.type(level) & now.dtype.type(1)).astype(bool)
            low = now.compress(~bit)
            plane = np.packbits(bit, bitorder="little")
            starts = range(0, len(plane), width)
            before.append(np.concatenate([[0], np.cumsum([int(np.bitwise_count(plane[s : s + width]).sum()) for s in starts])]).astype(np.uint64))
            body += [squeeze.compress(plane[s : s + width].tobytes()) for s in starts]
            zeros.append(len(low))
            now = np.concatenate([low, now.compress(bit)])
        place = np.concatenate([[0], np.cumsum([len(x) for x in body])]).astype(np.uint64)
        return cls(b"".join([_HEAD.pack(_MAGIC, n, len(zeros)), np.array(zeros, np.uint64).tobytes(), *(x.tobytes() for x in before), place.tobytes(), *body]))

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        return cls(raw)

    @classmethod
    def open(cls, path: str) -> WaveletMatrix:
        """A file that holds :meth:`to_bytes`, mapped: only what is touched is read."""
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def to_bytes(self) -> bytes:
        return bytes(self.raw)

    def _block(self, level: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's bytes, and the set bits before each of them."""
        k = level * self.blocks + block
        held = self._kept.get(k)
        if held is None:
            a, b = int(self.place[k]), int(self.place[k + 1])
            self.touched += b - a
            bits = np.frombuffer(self._open.decompress(bytes(self.raw[a:b])), np.uint8)
            held = bits, np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
            if len(self._kept) >= KEPT:
                self._kept.pop(next(iter(self._kept)))
            self._kept[k] = held
        return held

    def _each_block(self, of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], of[order][1:] != of[order][:-1]])[: len(of)])
        for a, b in zip(cuts, [*cuts[1:], len(of)], strict=True):
            yield int(of[order[a]]), order[a:b]

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each position of a plane."""
        out = np.empty(len(at), np.int64)
        for block, which in self._each_block(at // BLOCK):
            out[which] = self.before[level][block]
            if block < self.blocks:
                bits, upto = self._block(level, block)
                inside = at[which] - block * BLOCK
                byte = inside >> 3
                masked = bits[np.minimum(byte, len(bits) - 1)] & ((1 << (inside & 7)) - 1).astype(np.uint8)
                out[which] += upto[byte] + np.where(byte < len(bits), np.bitwise_count(masked), 0)
        return out

    def _places(self, level: int, one: int, k: np.ndarray) -> np.ndarray:
        """Where a plane has its k-th (from 0) set or unset bits: the directory finds the block, the block the bit."""
        starts = self.before[level] if one else np.minimum(np.arange(self.blocks + 1) * BLOCK, self.n) - self.before[level]
        out = np.empty(len(k), np.int64)
        for block, which in self._each_block(np.searchsorted(starts, k, "right") - 1):
            bits, _ = self._block(level, block)
            here = np.flatnonzero(np.unpackbits(bits, bitorder="little", count=min(BLOCK, self.n - block * BLOCK)) == one)
            out[which] = block * BLOCK + here[k[which] - starts[block]]
        return out

    def access(self, at) -> np.ndarray:
        """The ids at the given positions."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            ones = self._ones(level, at)
            bit = self._ones(level, at + 1) - ones
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            out = out << 1 | bit
        return out

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        if symbol >> self.levels or not self.n:
            return 0, 0
        for level in range(self.levels):
            a, b = self._ones(level, np.array([lo, hi])).tolist()
            if symbol >> (self.levels - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in positions lo to hi."""
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        return b - a

    rank = count

    def _up(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """From places in the order below the last plane to positions in the shard, a plane at a time for all of them."""
        for level in reversed(range(self.levels)):
            one = symbol >> (self.levels - 1 - level) & 1
            at = self._places(level, one, at - self.zeros[level] if one else at)
        return at

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th occurrence (from 0); ValueError if there are fewer."""
        a, b = self._range(symbol, 0, self.n)
        if not 0 <= k < b - a:
            raise ValueError(f"{symbol} occurs {b - a} times")
        return int(self._up(symbol, np.array([a + k]))[0])

    def occurrences(self, symbol: int) -> list[int]:
        a, b = self._range(symbol, 0, self.n)
        return self._up(symbol, np.arange(a, b)).tolist() if b > a else []

    def _plane(self, level: int) -> np.ndarray:
        parts = [self._open.decompress(bytes(self.raw[int(self.place[k]) : int(self.place[k + 1])])) for k in range(level * self.blocks, (level + 1) * self.blocks)]
        return np.unpackbits(np.frombuffer(b"".join(parts), np.uint8), count=self.n, bitorder="little").view(bool)

    def values(self) -> np.ndarray:
        """All ids in order, by undoing the partitions from the last plane up."""
        now = np.zeros(self.n, np.uint32)
        for up, level in enumerate(reversed(range(self.levels))):
            bit, zeros = self._plane(level), int(self.zeros[level])
            above = np.empty_like(now)
            above[np.flatnonzero(~bit)] = now[:zeros]
            above[np.flatnonzero(bit)] = now[zeros:] | np.uint32(1 << up)
            now = above
        return now


_SHARD = "range int, part int, before long, n_tokens long, doc_ids array<long>, lengths array<long>, shard binary"


def _write(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(path)
        ids: list[bytes] = []
        names: list[int | None] = []
        size, before, part, place = 0, 0, 0, None

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(ids), np.uint32))
            lengths = [len(x) // 4 for x in ids]
            row = {"range": [place], "part": [part], "before": [before], "n_tokens": [size], "doc_ids": [names], "lengths": [lengths], "shard": [matrix.to_bytes()]}
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for i, r, x in zip(rows["doc_id"].to_pylist(), rows["range"].to_pylist(), own.column(rows["text"], end), strict=True):
                    if size and size + len(x) // 4 > SHARD_TOKENS:
                        yield shard()
                        before, part, size, ids, names = before + size, part + 1, 0, [], []
                    ids.append(x)
                    names.append(i)
                    size, place = size + len(x) // 4, r
        if ids:
            yield shard()

    return run


def write(docs: DataFrame, to: str, path: str, end: int = 1) -> None:
    """Write the ids of every whole text, ``end`` after each document, in ascending doc_id order as wavelet shards.

    Null ids come first, ties by text; null text is empty; repeated rows are
    written as often as they occur.  A shard holds whole documents, up to
    ``SHARD_TOKENS`` ids (more only for a longer single document).  A lost task
    writes its shards again: the committed files are those of one attempt.
    """
    base = shared.own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    cuts = ranges.cut_points(base.select("doc_id"))
    dealt = ranges.dealt(base.withColumn("range", ranges.range_of("doc_id", cuts)), cuts)
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(_write(path, end), _SHARD).write.option("compression", "uncompressed").parquet(to)


def _read(first: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {k: batch[k][row] for k in ("range", "before", "doc_ids", "lengths", "shard")}
                values = WaveletMatrix.from_bytes(one["shard"].as_py()).values()
                names = one["doc_ids"].values
                ends = np.concatenate([[0], np.cumsum(one["lengths"].values.to_numpy())])
                start = ends[:-1] + first[one["range"].as_py()] + one["before"].as_py()
                for lo in range(0, len(names), 512):
                    hi = min(len(names), lo + 512)
                    part = values[ends[lo] : ends[hi]].astype("<u4")
                    offsets = ((ends[lo : hi + 1] - ends[lo]) * 4).astype(np.int64)
                    held = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(part.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([names.slice(lo, hi - lo), pa.array(start[lo:hi].astype(np.int64)), held], names=["doc_id", "start", "ids"])

    return run


def _starts(shards: DataFrame) -> dict[int, int]:
    """The ids before each range."""
    per = {r["range"]: r["n"] for r in shards.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect()}
    first, total = {}, 0
    for r in sorted(per):
        first[r], total = total, total + per[r]
    return first


def read(spark: SparkSession, where: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the shards of a folder: start counts the ids of all documents
    before it, ids are little-endian unsigned 32-bit.  An empty folder of shards gives no rows."""
    shards = spark.read.schema(_SHARD).parquet(where)
    return shards.select("range", "before", "doc_ids", "lengths", "shard").mapInArrow(_read(_starts(shards)), "doc_id long, start long, ids binary")


def counts(spark: SparkSession, where: str, symbols: list[int]) -> DataFrame:
    """(id, n): how often each of a few ids occurs in the shards of a folder.  A shard's directory and a few blocks are read for each id."""
    shards = spark.read.schema(_SHARD).parquet(where).select("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch["shard"]:
                matrix = WaveletMatrix(raw.as_buffer().to_pybytes())
                yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.int64()), pa.array([matrix.count(s) for s in symbols], pa.int64())], names=["id", "n"])

    return shards.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, where: str, symbols: list[int]) -> DataFrame:
    """(id, doc_id, at): every place of a few ids, ``at`` counted from its document's first id."""
    shards = spark.read.schema(_SHARD).parquet(where).select("doc_ids", "lengths", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, lengths, raw in zip(batch["doc_ids"], batch["lengths"], batch["shard"], strict=True):
                matrix, ends = WaveletMatrix(raw.as_buffer().to_pybytes()), np.cumsum(lengths.values.to_numpy())
                for s in symbols:
                    at = np.array(matrix.occurrences(s), np.int64)
                    doc = np.searchsorted(ends, at, "right")
                    inside = at - np.where(doc > 0, ends[np.maximum(doc - 1, 0)], 0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s)), names.values.take(pa.array(doc)), pa.array(inside)], names=["id", "doc_id", "at"])

    return shards.mapInArrow(run, "id long, doc_id long, at long")


def at_positions(spark: SparkSession, where: str, positions: list[int]) -> DataFrame:
    """(position, id) of a few positions, counted over all documents of a folder; those beyond the end have no row."""
    shards = spark.read.schema(_SHARD).parquet(where)
    first, wanted = _starts(shards), np.array(sorted(set(positions)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, before, n, raw in zip(batch["range"].to_pylist(), batch["before"].to_pylist(), batch["n_tokens"].to_pylist(), batch["shard"], strict=True):
                lo = first[place] + before
                mine = wanted[(wanted >= lo) & (wanted < lo + n)]
                if len(mine):
                    yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(WaveletMatrix(raw.as_buffer().to_pybytes()).access(mine - lo))], names=["position", "id"])

    return shards.select("range", "before", "n_tokens", "shard").mapInArrow(run, "position long, id long")
