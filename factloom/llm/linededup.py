"""Line dedup by winnowing.

Units are words (``dedup_passages``, which the queries use) or lines with a
word (``dedup``).  A shingle is the shortest run of units from one unit on
that has ``shingle_words`` words; a window is the shortest run that has
``words`` words.  Each window selects the least shingle hash inside it, so any
run of at least ``words`` words that repeats holds a whole window in both
places, with the same selection: a guaranteed fingerprint.

Neighbouring windows that select the shingle at one place make one position:
a row with the fingerprint and the hash of the whole neighbourhood, all units
of these windows.  There are about two positions for every
``words - shingle_words + 2`` windows, and only positions are joined:

* A position whose neighbourhood occurs at an earlier place is a repeat as far
  as its windows reach, both ways.  Only the first one of each goes on.
* Where one fingerprint has several neighbourhoods, the match ends somewhere
  inside them: it is extended unit by unit, by the hashes of their windows.

Each task first combines what it has: of equal neighbourhoods it gives out
the earliest one, so a passage in a third of all texts is a row a task.
Adjacent and overlapping repeats become one run, and later runs are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared


@dataclass(frozen=True)
class Runs:
    words: int = 50
    shingle_words: int = 25


#: What is to be deleted is broadcast up to this size; beyond, the texts are shuffled to it.  A row and a range take so many bytes in a broadcast.
BROADCAST_BYTES, ROW_BYTES, RANGE_BYTES = 32_000_000, 96, 40

#: Positions that a task holds before it combines them.
HELD = 1 << 18

_BASE = kernel.mix_int(0x6C696E65) | 1
_RANGES = "array<struct<lo:int,hi:int>>"
_ROWS = "rid long, ord long, lo int, hi int, s long, h long, later boolean"
_NAMES = ("rid", "ord", "lo", "hi", "s", "h")


class Windows:
    """The windows of a block's units: ``at`` and ``end``, the first and last unit of each; ``chosen``, the place of its shingle.

    hashes, row, number: of each unit, the last in its text; shingle_end: the last unit of the shingle from each unit, -1 without one.
    """

    def __init__(self, hashes: np.ndarray, row: np.ndarray, number: np.ndarray, window_end: np.ndarray, shingle_end: np.ndarray):
        n = len(hashes)
        self.row, self.number = row, number
        power, inverse = kernel._powers(_BASE, n + 1), kernel._powers(pow(_BASE, -1, 1 << 64), n + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n], dtype=np.uint64)])
        self.run = lambda a, b: kernel.mix((total[b + 1] - total[a]) * inverse[a] + (b - a).astype(np.uint64))
        self.at = np.flatnonzero(window_end >= 0)
        self.end = window_end[self.at]
        have = np.flatnonzero(shingle_end >= 0)
        self.shingle = np.full(n, (1 << 64) - 1, np.uint64)
        self.shingle[have] = self.run(have, shingle_end[have])
        # A window's shingles begin in its first unit up to the last place from which one still ends inside.
        last = np.searchsorted(_ascending(shingle_end), self.end, "right") - 1
        self.chosen = _earliest_least(self.shingle, self.at, np.minimum(last, self.end))

    def positions(self) -> tuple[np.ndarray, ...]:
        """(row, lo, hi, s, h) of each run of windows that select one place; lo and hi number the units."""
        new = np.ones(len(self.at), bool)
        new[1:] = self.chosen[1:] != self.chosen[:-1]
        i = np.flatnonzero(new)
        j = np.concatenate([i[1:], [len(self.at)]])[: len(i)] - 1
        a, b = self.at[i], self.end[j]
        return self.row[a], self.number[a], self.number[b], self.shingle[self.chosen[i]], self.run(a, b)

    def inside(self, marked: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, lo, hi, s, h) of each window in the positions that begin at marked units."""
        new = np.ones(len(self.at), bool)
        new[1:] = self.chosen[1:] != self.chosen[:-1]
        keep = marked[self.at[np.flatnonzero(new)]][np.cumsum(new) - 1] if len(self.at) else new
        a, b = self.at[keep], self.end[keep]
        return self.row[a], self.number[a], self.number[b], self.shingle[self.chosen[keep]], self.run(a, b)


def _ascending(end: np.ndarray) -> np.ndarray:
    """Shingle ends that never fall: a unit without a shingle has the next one's, so that none of its own row is taken."""
    filled = np.where(end >= 0, end, len(end) + 1)
    return np.minimum.accumulate(filled[::-1])[::-1]


def _earliest_least(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each range, the earliest place of its least value, from minima over ranges of powers of two."""
    span = last - first + 1
    out = np.zeros(len(first), np.int64)
    if not len(first):
        return out
    least, place, width = x, np.arange(len(x)), 1
    level = np.int64(1) << np.floor(np.log2(span)).astype(np.int64)
    while True:
        here = np.flatnonzero(level == width)
        a, b = first[here], last[here] - width + 1
        out[here] = np.where(least[b] < least[a], place[b], place[a])
        if width >= int(level.max()):
            return out
        other = least[width:] < least[:-width]
        least, place = np.where(other, least[width:], least[:-width]), np.where(other, place[width:], place[:-width])
        width *= 2


def words_of(data: np.ndarray, offsets: np.ndarray, conf: Runs) -> Windows:
    """Windows whose units are words."""
    of = kernel.Words(data, offsets)
    n, row = len(of.hash), of.row
    place = np.arange(n)
    last = of.first[1:][row] - 1 if n else place
    reach = lambda k: np.where(place + k - 1 <= last, place + k - 1, -1)
    return Windows(of.hash, row, place - of.first[row], reach(conf.words), reach(conf.shingle_words))


def lines_of(data: np.ndarray, offsets: np.ndarray, conf: Runs) -> Windows:
    """Windows whose units are the lines with a word."""
    starts, ends, first = kernel.spans(data != 10, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = kernel.Words(data, offsets)
    count = np.searchsorted(words.starts, ends) - np.searchsorted(words.starts, starts)
    broken = np.concatenate([[0], np.cumsum(data == 10)])
    keep = count > 0
    row, count = row[keep], count[keep]
    last, total = np.searchsorted(row, row, "right") - 1, np.cumsum(count)

    def reach(least: int) -> np.ndarray:
        end = np.searchsorted(total, total - count + least, "left")
        return np.where(end <= last, end, -1)

    return Windows(kernel.hash_spans(data, starts[keep], ends[keep]), row, broken[starts[keep]] - broken[offsets[:-1]][row], reach(conf.words), reach(conf.shingle_words))


Units = Callable[[np.ndarray, np.ndarray, Runs], Windows]


def _combined(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Of equal neighbourhoods the earliest by (ord, rid, lo); the others are repeats, ``later``, joined where they touch."""
    if not parts:
        return
    rid, order, lo, hi, s, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.lexsort((lo, rid, order, h))
    new = np.ones(len(by), bool)
    new[1:] = h[by[1:]] != h[by[:-1]]
    head = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    again = (order[head] != order[by]) | (rid[head] != rid[by]) | (lo[head] != lo[by])
    yield _rows(*(x[by[new]] for x in (rid, order, lo, hi, s, h)), later=False)
    late = by[again]
    late = late[np.lexsort((hi[late], lo[late], rid[late]))]
    if len(late):
        yield _rows(*_touching(rid[late], lo[late], hi[late]), later=True)


def _touching(rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges in ascending order, those that touch in one."""
    change = np.ones(len(rid), bool)
    change[1:] = rid[1:] != rid[:-1]
    group = np.cumsum(change) - 1
    wide = np.int64(1) << np.int64(33)
    reach = np.maximum.accumulate(hi.astype(np.int64) + group * wide) - group * wide
    new = change.copy()
    new[1:] |= lo[1:] > reach[:-1] + 1
    at = np.flatnonzero(new)
    end = np.concatenate([at[1:], [len(rid)]]) - 1
    none = np.zeros(len(at), np.int64)
    return rid[at], none, lo[at], reach[end], none, none.view(np.uint64)


def _rows(rid, order, lo, hi, s, h, later: bool) -> pa.RecordBatch:
    cols = [pa.array(rid), pa.array(order), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(s.view(np.int64)), pa.array(h.view(np.int64)), pa.array(np.full(len(rid), later))]
    return pa.RecordBatch.from_arrays(cols, names=[*_NAMES, "later"])


def _positions(units: Units, conf: Runs, marked: bool):
    """Positions of each text, or the windows in those of its positions that begin at ``places``; combined a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for at, to, data, offsets in kernel.blocks(batch["text"]):
                x = units(data, offsets, conf)
                if marked:
                    given = batch["places"].slice(at, to - at)
                    # A unit by (text, number): numbers ascend within a text.
                    wanted = np.repeat(np.arange(to - at), given.value_lengths().to_numpy()) << np.int64(32) | given.flatten().to_numpy().astype(np.int64)
                    row, lo, hi, s, h = x.inside(np.isin(x.row.astype(np.int64) << np.int64(32) | x.number, wanted))
                else:
                    row, lo, hi, s, h = x.positions()
                of = lambda c: batch[c].to_numpy(zero_copy_only=False)[at:to][row]  # noqa: E731, B023
                parts.append((of("rid"), of("ord"), lo, hi, s, h))
                held += len(row)
                if held > HELD:
                    yield from _combined(parts)
                    parts, held = [], 0
        yield from _combined(parts)

    return run


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = []
    for batch in batches:
        rid, order, lo, hi, s, h = (batch[c].to_numpy() for c in _NAMES)
        parts.append((rid, order, lo, hi, s.view(np.uint64), h.view(np.uint64)))
    yield from _combined(parts)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch["spans"]
        rid = np.repeat(batch["rid"].to_numpy(), spans.value_lengths().to_numpy())
        flat = spans.flatten()
        lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
        by = np.lexsort((hi, lo, rid))
        rid, _, lo, hi, _, _ = _touching(rid[by], lo[by], hi[by])
        at = np.flatnonzero(np.concatenate([[True], rid[1:] != rid[:-1]])[: len(rid)])
        ranges = pa.StructArray.from_arrays([pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["lo", "hi"])
        yield pa.RecordBatch.from_arrays([pa.array(rid[at]), pa.ListArray.from_arrays(pa.array(np.concatenate([at, [len(rid)]]).astype(np.int32)), ranges)], names=["rid", "removed"])


def _row_id():
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))


def _beside(runs: DataFrame, size: str) -> DataFrame:
    """Runs by their text, broadcast if they are small."""
    rows, ranges = runs.agg(F.count("*"), F.coalesce(F.sum(F.size(size)), F.lit(0))).first()
    return F.broadcast(runs) if rows * ROW_BYTES + ranges * RANGE_BYTES <= BROADCAST_BYTES else runs


def repeated(docs: DataFrame, units: Units, conf: Runs = Runs()) -> DataFrame:
    """(rid, removed): for each text, the merged ranges of the units in windows that occur at an earlier place.

    Earlier is by (doc_id, row, unit), null ids last; a run may repeat inside one text.
    """
    base = shared.own_columns(docs, "doc_id", "text").select(_row_id().alias("rid"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("ord"), "text")
    own = shared.stored(base.mapInArrow(kernel.tidy(_positions(units, conf, False)), _ROWS), "positions")
    firsts = shared.stored(own.filter("not later").repartition("h").mapInArrow(kernel.tidy(_first_of_each), _ROWS), "firsts")
    heads = firsts.filter("not later")
    several = heads.groupBy("s").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("s")
    places = shared.stored(heads.join(several, "s", "left_semi").groupBy("rid").agg(F.collect_set("lo").alias("places")), "places")
    fine = shared.stored(base.join(_beside(places, "places"), "rid").mapInArrow(kernel.tidy(_positions(units, conf, True)), _ROWS), "windows")
    ends = fine.filter("not later").repartition("h").mapInArrow(kernel.tidy(_first_of_each), _ROWS)
    late = [x.filter("later").select("rid", "lo", "hi") for x in (own, firsts, fine, ends)]
    every = late[0].unionByName(late[1]).unionByName(late[2]).unionByName(late[3])
    out = shared.stored(every.groupBy("rid").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")).mapInArrow(kernel.tidy(_merged), f"rid long, removed {_RANGES}"), "removed")
    shared.drop(own, firsts, places, fine)
    return out


def _applied(docs: DataFrame, runs: DataFrame, cut: Callable) -> DataFrame:
    """Every row with what is left of its text; the row travels as one column, so no column of it can clash."""
    rows = docs.select(_row_id().alias("rid"), F.struct(*docs.columns).alias("row"))
    none = F.array().cast(_RANGES)
    joined = rows.join(_beside(runs, "removed"), "rid", "left").select("row", F.coalesce("removed", none).alias("removed"))
    text = F.when(F.size("removed") == 0, F.col("row.text")).otherwise(cut(F.when(F.size("removed") > 0, F.col("row.text")), F.col("removed")))
    return joined.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c != "removed"], "removed")


def dedup(docs: DataFrame, conf: Runs = Runs()) -> DataFrame:
    """Every row of ``docs`` with later repeated runs of lines deleted from ``text``, and ``removed``, their line ranges.

    Lines are cut at \\n and compared byte for byte; lines without a word are no
    units and go only with a run around them.  A run counts from ``conf.words``
    words on; shorter repeats stay.  Null text stays null; a text that is all
    repeats becomes empty.  Repeated rows are one document and keep their first
    runs alike; texts with equal ids, and those with null ids, go in the order
    of a hash of id and text.  A text of any length is one row of work.  Extra
    columns are carried, whatever their names; only an existing ``removed`` is
    replaced.  An empty table gives no rows.
    """

    def cut(text, gone):
        left = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.exists(gone, lambda r: (i >= r["lo"]) & (i <= r["hi"])))
        return F.array_join(left, "\n")

    return _applied(docs, repeated(docs, lines_of, conf), cut)


def _without(text: bytes, gone: list[dict[str, int]]) -> bytes:
    """A text without ranges of its words; of the white space at both ends of a range, the side with a line break stays."""
    at = kernel.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    starts, ends, out, done = at.starts.tolist(), at.ends.tolist(), [], 0
    for r in gone:
        a, b = r["lo"], r["hi"]
        before = text[ends[a - 1] if a else 0 : starts[a]]
        lo, hi = starts[a], starts[b + 1] if b + 1 < len(starts) else len(text)
        if b + 1 == len(starts) or (a and b"\n" not in before and b"\n" in text[ends[b] : hi]):
            lo, hi = lo - len(before), len(text) if b + 1 == len(starts) else ends[b]
        out.append(text[done:lo])
        done = max(done, hi)
    return b"".join([*out, text[done:]])


def dedup_passages(docs: DataFrame, conf: Runs = Runs()) -> DataFrame:
    """Every row of ``docs`` with later repeated passages deleted from ``text``, and ``removed``, their word ranges.

    A passage may begin and end inside a line.  Words are parted by ASCII white
    space and compared byte for byte; of the window size on, every word in a
    repeat goes.  Else as :func:`dedup`.
    """

    @F.pandas_udf("string")
    def left(text: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else _without(t.encode(), g).decode() for t, g in zip(text, gone, strict=True)], dtype=object)

    return _applied(docs, repeated(docs, words_of, conf), left)
