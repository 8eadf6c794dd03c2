"""The best chunks of whole documents for questions, by TF-IDF cosine, without a table of postings.

Same results as postings, idf, weights and cosine_topk of :mod:`retrieve` over
all chunks.  Words and pairs are 56-bit hashes.  A chunk's dot product needs
only the questions' terms; its length needs how many chunks hold each of its
terms, so that is counted for few chunks only:

1. count the chunks per question term, and per bucket of all terms: a bucket's
   count is at least that of each term in it, so lengths have lower bounds;
2. keep for each question the chunks whose score may still be among the best;
3. count the chunks per term of those, and score them exactly.

No bound is a cut: what may be among the best is scored, however many they are.
"""

from __future__ import annotations

import math
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..schema import CHUNK_CHARS, CHUNK_OVERLAP
from ..storage import drop, releasing, stored
from . import chunks, retrieve

#: Buckets of step 1, as a power of two; chunks of each question that are scored first; chunks that are scored at once; terms that are counted in one scan.
BUCKET_BITS, FIRST, AT_ONCE, TERMS = 24, 20, 20_000, 4_000_000
_BLOCK = 1 << 17
_ROWS = 256
_HASH = np.uint64((1 << 56) - 1)
#: Codes of a bucket's count are tenths of ln(1 + count), rounded up.
_CODES = 10.0
#: Scores are compared after rounding to nine places.
_MARGIN = 2e-9


@cache
def _word_characters() -> np.ndarray:
    """Whether a code point is in retrieve.terms' words, (?U)\\w: letters, marks, decimal digits, connectors, joiners, letter numbers and circled letters."""
    kinds = {"Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Me", "Nd", "Nl", "Pc"}
    inside = np.fromiter((unicodedata.category(chr(c)) in kinds for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    for a, b in ((0x200C, 0x200D), (0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189)):
        inside[a : b + 1] = True
    return inside


_BASE = 0x9E3779B97F4A7C15


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _power(base: int, size: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64, ``size`` at least."""
    return _powers(base, 1 << max(size - 1, 1 << 16).bit_length())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the words of at least two characters, in their order."""
    points = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.concatenate([[False], _word_characters()[points], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    long = end - start > 1
    start, end = start[long], end[long]
    up, down = _power(_BASE, len(points) + 1), _power(pow(_BASE, -1, 1 << 64), len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    hashes = _mixed((sums[end] - sums[start]) * down[start])
    ends = np.flatnonzero(points == 10)
    if len(ends) != len(texts) - 1:  # line ends of their own
        ends = np.cumsum([len(t.lower()) + 1 for t in texts[:-1]]) - 1
    return np.searchsorted(ends, start), hashes


@cache
def _left_out(stop: tuple[str, ...]) -> _Lookup:
    own = [w for w in stop if len(w) > 1]
    at, hashes = _words(own or ["  "])
    return _Lookup(np.unique(hashes[np.bincount(at, minlength=len(own) or 1)[at] == 1]), 64)


def _spread(texts: list[str], stop: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of at most 256 texts: words, then pairs of neighbours, as often as they are there."""
    row, words = _words(texts)
    kept = np.ones(len(words), bool)
    kept[_left_out(stop)(words)[0]] = False
    row, words = row[kept], words[kept]
    near = row[1:] == row[:-1]
    return np.concatenate([row, row[1:][near]]), np.concatenate([words, _paired(words[:-1][near], words[1:][near])]) >> np.uint64(8)


def _counted(texts: list[str], stop: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of at most 256 texts, by row and term."""
    row, term = _spread(texts, stop)
    key = (row.astype(np.uint64) << np.uint64(56)) | term
    key.sort()
    first = np.flatnonzero(np.concatenate([key[:1] >= 0, key[1:] != key[:-1]]))
    tf = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(56)).astype(np.int64), key & _HASH, tf


class _Lookup:
    """Places of terms in a sorted array; most that aren't there are told by a bit of their first digits."""

    def __init__(self, terms: np.ndarray, width: int = 56):
        bits = min(24, max(12, len(terms).bit_length() + 4))
        self.terms, self.shift = terms, np.uint64(width - bits)
        self.there = np.zeros(1 << bits, bool)
        self.there[terms >> self.shift] = True

    def __call__(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the asked are there, their places)"""
        which = np.flatnonzero(self.there[asked >> self.shift])
        at = np.searchsorted(self.terms, asked[which])
        at[at == len(self.terms)] = 0
        same = self.terms[at] == asked[which] if len(self.terms) else np.zeros(len(at), bool)
        return which[same], at[same]


def _decoded(column: pa.Array) -> list[str | None]:
    return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def _windows(body: str, most: int, overlap: int) -> Iterator[str]:
    """As chunks.windows."""
    step = most - overlap
    for i in range(1 if len(body) <= most else -(-(len(body) - most) // step) + 1):
        yield body[i * step : i * step + most]


def _cut(batches: Iterator[pa.RecordBatch], most: int, overlap: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, str, str]]]]:
    """Batches with at most 256 of their chunks (row, chunk_index, section, text) at a time."""
    for batch in batches:
        parts = batch.column("parts")
        offsets, values = parts.offsets.to_pylist(), parts.values
        names, bodies = _decoded(values.field("section")), None
        out: list[tuple[int, int, str, str]] = []
        for row in range(batch.num_rows):
            index = 0
            lo, hi = offsets[row], offsets[row + 1]
            bodies = _decoded(values.field("body").slice(lo, hi - lo))
            for name, body in zip(names[lo:hi], bodies):
                for text in _windows(body, most, overlap) if body else ():
                    out.append((row, index, name, text))
                    index += 1
                    if len(out) == _ROWS:
                        yield batch, out
                        out = []
        if out:
            yield batch, out


def _packed(kind: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (kind, block, at, n): where a block's counts aren't 0, and what they are."""
    def small(x: np.ndarray) -> bytes:
        return zlib.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)

    for block in range(-(-len(counts) // _BLOCK)):
        own = counts[block * _BLOCK : (block + 1) * _BLOCK]
        at = np.flatnonzero(own)
        if len(at):
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int32()), "at": [small(np.diff(at, prepend=0))], "n": [small(own[at])]})


_PACKED = "kind int, block int, at binary, n binary"


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of packed counts; of kind 0 their codes."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for r in batch.to_pylist():
            own = sums.setdefault((r["kind"], r["block"]), np.zeros(_BLOCK, np.int64))
            own[np.cumsum(_unpacked(r["at"]))] += _unpacked(r["n"])
    for (kind, block), own in sums.items():
        data = own if kind else np.ceil(np.log1p(own) * _CODES).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int32()), "n": [zlib.compress(data.tobytes(), 1)]})


def _totals(packed: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    with releasing(packed.sparkSession):
        rows = packed.repartition(16, "kind", "block").mapInArrow(_summed, "kind int, block int, n binary").collect()
    out = {k: np.zeros(-(-size // _BLOCK) * _BLOCK, np.int64 if k else np.uint8) for k, size in sizes.items()}
    for r in rows:
        out[r["kind"]][r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(zlib.decompress(r["n"]), out[r["kind"]].dtype)
    return {k: out[k][:size] for k, size in sizes.items()}


def _idf(n: int, df: np.ndarray) -> np.ndarray:
    return np.log((1.0 + n) / (1.0 + df)) + 1.0


class _Questions:
    """Terms of the questions, and by term the questions that hold it with their weights."""

    def __init__(self, counts: list[dict[int, int]]):
        self.counts = counts
        self.terms = np.array(sorted({t for c in counts for t in c}), np.uint64)

    def weigh(self, n: int, df: np.ndarray) -> None:
        """Terms that no chunk has weigh nothing, in lengths too."""
        self.idf = np.where(df > 0, _idf(n, df), 0.0)
        by_term: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for q, c in enumerate(self.counts):
            at = np.searchsorted(self.terms, np.array(sorted(c), np.uint64))
            w = np.array([c[t] for t in sorted(c)], float) * self.idf[at]
            length = math.sqrt(float((w * w).sum()))
            for i, x in zip(at, w):
                if x > 0:
                    by_term[i].append((q, x / length))
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in by_term])]).astype(np.int64)
        self.question = np.array([q for x in by_term for q, _ in x], np.int64)
        self.weight = np.array([w for x in by_term for _, w in x], float)

    def dots(self, row: np.ndarray, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, row, dot product) of terms at places ``at`` with weights w."""
        many = self.start[at + 1] - self.start[at]
        each = np.repeat(np.arange(len(at)), many)
        place = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + self.start[at][each]
        key, where = np.unique(self.question[place] * _ROWS + row[each], return_inverse=True)
        return key // _ROWS, key % _ROWS, np.bincount(where, w[each] * self.weight[place], len(key))


def _count(shared, bits: int, most: int, overlap: int, stop: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        find = _Lookup(terms)
        buckets, exact = np.zeros(1 << bits, np.int32), np.zeros(len(terms) + 1, np.int64)
        waiting: list[np.ndarray] = []

        def add() -> None:
            own = np.sort(np.concatenate([np.zeros(0, np.uint32), *waiting]))
            first = np.flatnonzero(np.concatenate([own[:1] >= 0, own[1:] != own[:-1]]))
            buckets[own[first]] += np.diff(np.append(first, len(own))).astype(np.int32)
            waiting.clear()

        for _, cut in _cut(batches, most, overlap):
            row, term = _spread([c[3] for c in cut], stop)
            exact[-1] += np.count_nonzero(np.bincount(row, minlength=1))
            which, at = find(term)
            here, many = np.unique(np.unique(at * _ROWS + row[which]) // _ROWS, return_counts=True)
            exact[here] += many
            if bits:
                waiting.append((term >> np.uint64(56 - bits)).astype(np.uint32))
                if len(waiting) == 32:
                    add()
        if bits:
            add()
            yield from _packed(0, buckets)
        yield from _packed(1, exact)

    return run


def _best(question: np.ndarray, low: np.ndarray, k: int, questions: int) -> np.ndarray:
    """The k-th highest of each question; 0 where there are fewer."""
    order = np.lexsort((-low, question))
    start = np.searchsorted(question[order], np.arange(questions))
    end = np.searchsorted(question[order], np.arange(questions), side="right")
    out = np.zeros(questions)
    enough = end - start >= k
    out[enough] = low[order][start[enough] + k - 1]
    return out


def _bound(shared, k: int, bits: int, most: int, overlap: int, stop: tuple[str, ...], schema: pa.Schema):
    """Chunks (question, ..., low, high) whose score, between low and high, may be among a task's k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, codes = shared.value
        questions = len(own.counts)
        find = _Lookup(own.terms)
        least = np.maximum(math.log(1.0 + n) - np.arange(256) / _CODES + 1.0, 1.0)
        highest = float(_idf(n, np.array(1.0)))
        floor = np.zeros(questions)
        kept: list[tuple] = []
        texts: dict[int, tuple] = {}
        seen = fresh = 0

        def pruned() -> tuple:
            q, at, low, high, mark = (np.concatenate(x) for x in zip(*kept))
            np.maximum(floor, _best(q, low, k, questions), out=floor)
            # Of chunks with the same terms, the k first by id are enough.
            some = np.flatnonzero(high + _MARGIN >= floor[q])
            names = np.array([texts[i][5] for i in at[some].tolist()], object)
            order = some[np.lexsort((names.astype(str), mark[some], q[some]))]
            same = np.concatenate([[False], (q[order][1:] == q[order][:-1]) & (mark[order][1:] == mark[order][:-1])]) if len(order) else np.zeros(0, bool)
            start = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else np.zeros(0, np.int64)
            order = order[np.arange(len(order)) - start < k]
            return q[order], at[order], low[order], high[order], mark[order]

        for batch, cut in _cut(batches, most, overlap):
            row, term, tf = _counted([c[3] for c in cut], stop)
            which, at = find(term)
            lower = tf * least[codes[(term >> np.uint64(56 - bits)).astype(np.int64)]]
            upper = tf * highest
            exact = tf[which] * own.idf[at]
            lower[which] = upper[which] = exact
            low2, high2 = np.bincount(row, lower * lower, _ROWS), np.bincount(row, upper * upper, _ROWS)
            mark = np.zeros(_ROWS, np.uint64)
            np.add.at(mark, row, _paired(term, tf.astype(np.uint64)))
            q, r, dot = own.dots(row[which], at, exact)
            low, high = dot / np.sqrt(high2[r]), dot / np.sqrt(low2[r])
            some = high + _MARGIN >= floor[q]
            q, r, low, high = q[some], r[some], low[some], high[some]
            if len(q):
                kept.append((q, r + seen, low, high, mark[r]))
                fresh += len(q)
                for i in np.unique(r).tolist():
                    at_row, index, section, text = cut[i]
                    doc, copy = batch.column("doc")[at_row].as_py(), batch.column("copy")[at_row].as_py()
                    texts[seen + i] = (doc, copy, index, section, text, _chunk_id(doc, copy, index))
            seen += _ROWS
            if fresh > max(50_000, 20 * k * questions):
                kept = [pruned()]
                still = set(kept[0][1].tolist())
                texts = {i: t for i, t in texts.items() if i in still}
                fresh = 0
        if kept:
            q, at, low, high, _ = pruned()
            for i in range(0, len(q), 2000):
                rows = [texts[j] for j in at[i : i + 2000].tolist()]
                columns = [q[i : i + 2000].tolist(), *([t[c] for t in rows] for c in (5, 0, 3, 4)), low[i : i + 2000], high[i : i + 2000]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _chunk_id(doc, copy: int, index: int) -> str:
    return "#".join(str(x) for x in ((doc,) if doc is not None else ()) + ((copy,) if copy else ()) + (index,))


def _terms(stop: tuple[str, ...]):
    """Terms of chunks, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in batches:
            texts = _decoded(batch.column("text"))
            parts = [_spread(texts[i : i + _ROWS], stop)[1] for i in range(0, len(texts), _ROWS)]
            own = np.unique(np.concatenate([own, *parts]))
        yield pa.RecordBatch.from_pydict({"term": own.view(np.int64)})

    return run


def _score(shared, stop: tuple[str, ...], schema: pa.Schema):
    """Exact scores of chunks (question, ..., text, ...), rounded to nine places in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, terms, df = shared.value
        weights = _idf(n, df)
        find = _Lookup(own.terms)
        for whole in batches:
            for i in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(i, _ROWS)
                row, term, tf = _counted(_decoded(batch.column("text")), stop)
                w = tf * weights[np.searchsorted(terms, term)]
                length = np.sqrt(np.bincount(row, w * w, batch.num_rows))
                which, at = find(term)
                q, r, dot = own.dots(row[which], at, w[which])
                mine = np.asarray(batch.column("question"))[r] == q
                got = np.zeros(batch.num_rows)
                got[r[mine]] = dot[mine] / length[r[mine]]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("question", "chunk_id", "doc", "section", "text")), pa.array(got)], schema=schema)

    return run


def _documents(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, list[DataFrame]]:
    """(doc, copy, parts), where copy numbers the rows with one key if keys repeat; and the stored tables behind it."""
    rows = docs.select(docs[key].alias("doc"), docs[text].alias("body"))
    parts = F.transform(chunks.sections(F.col("body")), lambda s: F.struct(s["section"].alias("section"), s["body"].alias("body"))).alias("parts")
    with releasing(docs.sparkSession):
        repeated = stored(rows.groupBy("doc").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("doc").alias("_doc")), "repeated")
        unique = repeated.isEmpty()
    if unique:
        drop(repeated)
        return rows.select("doc", F.lit(0).cast("long").alias("copy"), parts), []
    same = F.col("doc").eqNullSafe(F.col("_doc"))
    once = rows.join(repeated, same, "left_anti").withColumn("copy", F.lit(0).cast("long"))
    again = rows.join(repeated, same, "left_semi").withColumn("copy", F.row_number().over(Window.partitionBy("doc").orderBy("body")).cast("long"))
    return once.unionByName(again).select("doc", "copy", parts), [repeated]


def best_chunks(docs: DataFrame, key: str, text: str, questions: DataFrame, question_key: str, question: str, k: int, most: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP, stop: tuple[str, ...] = retrieve.LEFT_OUT, bits: int = BUCKET_BITS, first: int = FIRST, at_once: int = AT_ONCE, slice_terms: int = TERMS) -> DataFrame:
    """(question_key, chunk_id, score, rank, key, section, text): of equal scores the smaller chunk_id comes first.

    Questions and their terms are held by every task; rows of one question_key
    are one question, those without it none.  Documents are read three times,
    once more where the first scored leave open which are best, and for each
    further ``slice_terms`` terms of the scored chunks.
    """
    spark = docs.sparkSession
    ids: dict = {}
    counts: list[dict[int, int]] = []
    for r in questions.select(question_key, question).collect():
        if r[0] is not None and r[1] is not None:
            _, term, tf = _counted([r[1]], stop)
            if len(term):
                c = counts[ids.setdefault(r[0], len(ids))] if r[0] in ids else counts.append({}) or counts[ids.setdefault(r[0], len(ids))]
                for t, m in zip(term.tolist(), tf.tolist()):
                    c[t] = c.get(t, 0) + m
    own = _Questions(counts)
    rows, repeated = _documents(docs, key, text)
    sc = spark.sparkContext

    shared = sc.broadcast(own.terms)
    got = _totals(rows.mapInArrow(_count(shared, bits, most, overlap, stop), _PACKED), {0: 1 << bits, 1: len(own.terms) + 1})
    shared.destroy()
    n, codes = int(got[1][-1]), got[0]
    own.weigh(n, got[1][:-1])

    named = [StructField("question", LongType()), StructField("chunk_id", StringType()), StructField("doc", docs.schema[key].dataType), StructField("section", StringType()), StructField("text", StringType())]
    bounded = StructType([*named, StructField("low", DoubleType()), StructField("high", DoubleType())])
    scored = StructType([*named, StructField("score", DoubleType())])
    shared = sc.broadcast((own, n, codes))
    maybe = stored(rows.mapInArrow(_bound(shared, k, bits, most, overlap, stop, to_arrow_schema(bounded)), bounded), "maybe")
    shared.destroy()
    del codes, got

    def floors(of: DataFrame, column: str) -> DataFrame:
        w = Window.partitionBy("question").orderBy(F.col(column).desc())
        return of.select("question", column, F.row_number().over(w).alias("_at")).filter(F.col("_at") == k).select("question", F.col(column).alias("_floor"))

    def above(of: DataFrame, floor: DataFrame) -> DataFrame:
        return of.join(F.broadcast(floor), "question", "left").filter(F.col("high") + _MARGIN >= F.coalesce("_floor", F.lit(0.0))).drop("_floor")

    def exact(of: DataFrame) -> DataFrame:
        with releasing(spark):
            terms = np.sort(np.asarray(of.select("text").mapInArrow(_terms(stop), "term long").distinct().toArrow()["term"].combine_chunks()).view(np.uint64))
        df = np.zeros(len(terms), np.int64)
        for i in range(0, len(terms), slice_terms):
            some = sc.broadcast(terms[i : i + slice_terms])
            df[i : i + slice_terms] = _totals(rows.mapInArrow(_count(some, 0, most, overlap, stop), _PACKED), {1: len(some.value) + 1})[1][:-1]
            some.destroy()
        given = sc.broadcast((own, n, terms, df))
        out = stored(of.select(*(f.name for f in named)).mapInArrow(_score(given, stop, to_arrow_schema(scored)), scored), "scored")
        given.destroy()
        return out

    open_ = stored(above(maybe, floors(maybe, "low")).withColumn("_nth", F.row_number().over(Window.partitionBy("question").orderBy(F.col("high").desc(), "chunk_id"))), "open")
    drop(maybe)
    if open_.count() <= at_once:
        done = exact(open_)
    else:
        done = exact(open_.filter(F.col("_nth") <= first))
        rest = above(open_.filter(F.col("_nth") > first), floors(done, "score"))
        if not rest.isEmpty():
            done = done.unionByName(exact(rest))
    drop(open_, *repeated)
    w = Window.partitionBy("question").orderBy(F.col("score").desc(), "chunk_id")
    top = done.withColumn("score", F.round("score", 9)).withColumn("rank", F.row_number().over(w)).filter((F.col("rank") <= k) & (F.col("score") > 0))
    names = spark.createDataFrame([(i, q) for q, i in ids.items()], StructType([StructField("question", LongType()), StructField(question_key, questions.schema[question_key].dataType)]))
    return top.join(F.broadcast(names), "question").select(question_key, "chunk_id", "score", "rank", F.col("doc").alias(key), "section", "text")
