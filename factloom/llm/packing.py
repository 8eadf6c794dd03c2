"""Best-fit packing of token sequences after a Martello-Toth dominance reduction.

What decides a packing is the histogram of piece lengths: at most ``capacity``
numbers, whatever the corpus.  The reduction fixes piece sets that provably
dominate every alternative (an exact filler; a largest single partner where
two never fit; a piece that nothing fits beside), shrinks the histogram, and
best fit decreasing packs the rest.  The plan says for each length which
ranks go to which sequences; pieces find their place by their rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel, shared, tokens


@dataclass
class Plan:
    """Rows (length, first rank, pieces a sequence, first sequence, first offset), ranks ascending in each length."""

    capacity: int
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    fixed: int = 0
    _next: dict[int, int] = field(default_factory=lambda: defaultdict(int))

    def place(self, length: int, pieces: int, each: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self._next[length], each, sequence, offset))
        self._next[length] += pieces

    def opened(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n


def _reduce(count: np.ndarray, plan: Plan) -> None:
    size = plan.capacity

    def fix(long: int, short: int | None, n: int) -> None:
        base = plan.opened(n)
        plan.fixed += n
        count[long] -= n
        if short == long:
            count[long] -= n
            plan.place(long, 2 * n, 2, base, 0)
            return
        plan.place(long, n, 1, base, 0)
        if short is not None:
            count[short] -= n
            plan.place(short, n, 1, base, long)

    # An exact filler k of j dominates: whatever else shares a sequence with j fits in k's stead.
    if count[size]:
        fix(size, None, int(count[size]))
    for long in range(size - 1, size // 2 - (size % 2 == 0), -1):
        short = size - long
        if short > long:
            break
        n = int(count[long] // 2 if short == long else min(count[long], count[short]))
        if n:
            fix(long, short, n)
    for long in range(size - 1, 0, -1):
        while count[long]:
            left = np.flatnonzero(count)
            least = int(left[0])
            if long == least and count[long] == 1 or long + least > size:
                fix(long, None, int(count[long]) if long + least > size else 1)
                continue
            second = least if count[least] - (long == least) > 1 else int(left[1]) if len(left) > 1 else size
            if long + least + second <= size:
                return
            # At most one more piece fits beside this one, so the largest that does dominates.
            fits = left[left <= size - long]
            best = int(fits[-1])
            if best == long and count[long] < 2:
                best = int(fits[-2]) if len(fits) > 1 else -1
            if best < 0:
                fix(long, None, 1)
            else:
                fix(long, best, int(count[long] // 2 if best == long else min(count[long], count[best])))


def _best_fit(count: np.ndarray, plan: Plan) -> None:
    """Best fit decreasing over groups of equally filled sequences: rooms[r] are (first sequence, how many) with r left."""
    size, rooms, order = plan.capacity, defaultdict(list), []

    def put(room: int, base: int, n: int) -> None:
        if n and room:
            if not rooms[room]:
                insort(order, room)
            rooms[room].append((base, n))

    for length in range(size, 0, -1):
        left = int(count[length])
        while left:
            at = bisect_left(order, length)
            if at == len(order):
                each = size // length
                n, room = -(-left // each), size
                base = plan.opened(n)
            else:
                room = order[at]
                base, n = rooms[room].pop()
                if not rooms[room]:
                    order.pop(at)
                each = room // length
            full = min(n, left // each)
            if full:
                plan.place(length, full * each, each, base, size - room)
                put(room - each * length, base, full)
                left -= full * each
            if full < n and left:
                plan.place(length, left, left, base + full, size - room)
                put(room - left * length, base + full, 1)
                left, full = 0, full + 1
            put(room, base + full, n - full)
        count[length] = 0


def plan(lengths: dict[int, int], capacity: int) -> Plan:
    """The packing of ``lengths`` (length: how many pieces) into sequences of ``capacity``."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in lengths.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length}")
        count[length] = n
    out = Plan(capacity)
    _reduce(count, out)
    _best_fit(count, out)
    return out


_PIECE = "part int, doc_id long, piece int, start long, length long, rank long, ids binary"


def _cut(path: str, capacity: int, end: int, carried: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part = tokens.encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids, piece, start, raw, source = [], [], [], [], []
                for k, (i, x) in enumerate(zip(rows["doc_id"].to_pylist(), own.column(rows["text"], end), strict=True)):
                    for n, lo in enumerate(range(0, len(x), 4 * capacity)):
                        ids.append(i)
                        piece.append(n)
                        start.append(lo // 4)
                        raw.append(x[lo : lo + 4 * capacity])
                        source.append(k)
                length = [len(x) // 4 for x in raw]
                rank = []
                for n in length:
                    rank.append(seen[n])
                    seen[n] += 1
                out = [pa.array([part] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(rank, pa.int64()), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=["part", "doc_id", "piece", "start", "length", "rank", "ids"])

    return run


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """A stored table of every document's pieces with their ids: whole documents, longer ones cut at ``capacity``.

    rank counts equal lengths in a task's part.  Null text is the ``end`` id
    alone; null ids are kept; repeated rows and rows with equal ids are
    documents of their own.  A text of any length is cut whole; further columns
    are not read.  An empty table gives no rows.
    """
    base = shared.own_columns(docs, "doc_id", "text")
    return shared.stored(base.mapInArrow(kernel.tidy(_cut(path, capacity, end, False)), _PIECE), "pieces")


def placed(table: DataFrame, capacity: int = 4096) -> tuple[DataFrame, Plan]:
    """``table`` (part, length, rank, more columns) with sequence_id and offset, and the plan behind them.

    Pieces of one length change places without changing the packing: they are
    dealt by part, then rank.  The driver holds a count for each length.  An
    empty table gives no rows.
    """
    per = table.groupBy("length", "part").agg(F.count("*").alias("n"))
    per = shared.stored(per, "lengths")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = plan(counts, capacity)
    rows = np.array(sorted(made.rows), dtype=np.int64).reshape(-1, 5)
    key = rows[:, 0] << 44 | rows[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(key, n << 44 | r, "right") - 1
        i, each = r - rows[at, 1], rows[at, 2]
        return pd.DataFrame({"sequence_id": rows[at, 3] + i // each, "offset": rows[at, 4] + i % each * n})

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    ranked = table.join(first, ["length", "part"]).withColumn("place", find(F.col("length"), F.col("rank") + F.col("first")))
    return ranked.select(*table.columns, "place.sequence_id", "place.offset"), made
