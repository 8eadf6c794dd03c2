"""Language-model scoring by a weighted backoff automaton.

Smoothed 1- to 3-grams become states with failure arcs: a state without an arc
for the next word adds its backoff weight and goes on at a shorter history.
The state before a word is known from the two words before it, so a block's
words are traversed together, each from the state that the words to its left
have led to.

Words and n-grams are known by 64-bit hashes.  Counts cover every training
document; the model holds all words, and all 2- and 3-grams from a fixed count
on, in distributed tables.  Tasks hold a hot part of the automaton, bounded by
parameters, with the whole model's backoff weights.  What a word or n-gram
outside it adds to the traversal comes from the tables: tasks send what they
don't hold to the shards of the tables, and get back a sum for each document.

Counting and asking go through shards by hash.  A task combines its n-grams
first and sends each shard one packed message, so a hot n-gram is one entry a
task; where rows of one history have to meet, hot histories are dealt by the
whole n-gram, as tasks hold their counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared


@dataclass(frozen=True)
class Orders:
    """head: words whose counts tasks hold; pairs, triples: words of the 2- and 3-grams that tasks hold;
    grams: of each order that tasks may hold; discount: of 2- and 3-grams; smoothing: of the base score;
    least: the count from which a 2- or 3-gram is in the model; rounds: parts of the texts that are scored
    one after the other, so that what is asked for one of them is all that disks hold at a time.
    """

    head: int = 1 << 17
    pairs: int = 4096
    triples: int = 512
    grams: int = 1 << 18
    discount: float = 0.6
    smoothing: float = 0.1
    least: int = 2
    rounds: int = 2


END = kernel.mix_int(0x656E64)

#: Tokens for each shard, about; entries that a task holds before it sends them.
SHARD_TOKENS, HELD = 1 << 21, 1 << 20


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each row followed by the end token, and the first of each row."""
    words = kernel.Words(data, offsets, lower=True)
    n = len(words.counts)
    first = words.first + np.arange(n + 1)
    out = np.empty(len(words.hash) + n, np.uint64)
    out[np.arange(len(words.hash)) + words.row] = words.hash
    out[first[1:] - 1] = END
    return out, first


class _Counter:
    """Exact counts of 64-bit keys in one task, merged as they come."""

    def __init__(self, most: int = 1 << 22):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.most = 0, most

    def add(self, keys: np.ndarray) -> None:
        key, count = np.unique(keys, return_counts=True)
        self.parts.append((key, count.astype(np.int64)))
        self.size += len(key)
        if self.size > self.most:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
            self.most = max(self.most, 2 * self.size)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        key, at, count = _grouped(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))
        return key[at], count


def _grouped(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, one place of each distinct key in ascending order, its summed n)."""
    order = np.argsort(key)
    ascending = key[order]
    at = np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]])[: len(key)])
    return key, order[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _words(shards: int):
    """Messages with a task's distinct words and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            for _, _, data, offsets in kernel.blocks(batch["text"]):
                counter.add(token_stream(data, offsets)[0])
        key, n = counter.merged()
        rows = [(shard, 0, 0, _message(np.diff(key[at], prepend=np.uint64(0)), n[at])) for shard, at in _by_shard((key % np.uint64(shards)).astype(np.int64), shards)]
        if rows:
            yield _sent(rows)

    return run


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n) of the words of each shard; a task's distinct words are its counter's, so a frequent word is one entry a task."""
    for _, got in sorted(_held(batches).items()):
        counter = _Counter()
        for _, raw in got:
            step, n = _received(raw, np.uint64, np.int64)
            counter.parts.append((np.cumsum(step, dtype=np.uint64), n))
        key, n = counter.merged()
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


class Finder:
    """Places of 64-bit hashes in a sorted array: their top bits give the place to look at first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = 1 + max(1, int(np.ceil(np.log2(len(keys) + 1))))
        self.start = np.searchsorted(keys, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The place of each, or -1."""
        out = np.full(len(x), -1, np.int64)
        if not len(self.keys):
            return out
        at = self.start[(x >> np.uint64(64 - self.bits)).astype(np.int64)]
        held = self.keys[np.minimum(at, len(self.keys) - 1)]
        np.copyto(out, at, where=(held == x))
        left = np.flatnonzero((held < x) & (at < len(self.keys)))
        at = at[left] + 1
        while len(left):
            inside = at < len(self.keys)
            at, left = at[inside], left[inside]
            held = self.keys[at]
            same = held == x[left]
            out[left[same]] = at[same]
            more = held < x[left]
            at, left = at[more] + 1, left[more]
        return out


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return kernel.mix(kernel.mix(before + np.uint64(2)) * np.uint64(0x2545F4914F6CDD1D) + word)


def triple_keys(first: np.ndarray, suf: np.ndarray) -> np.ndarray:
    """Of the first word and the key of the last two."""
    return kernel.mix(kernel.mix(first + np.uint64(3)) * np.uint64(0x9FB21C651E98DF25) + suf)


def _before(stream: np.ndarray, first: np.ndarray, of: np.ndarray, end) -> np.ndarray:
    """What ``of`` has for the word before each one; the end token opens each document."""
    out = np.empty_like(of)
    out[1:] = of[:-1]
    out[first[:-1]] = end
    return out


# Messages: arrays of one length, written by byte planes and compressed.


def _message(*arrays: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _received(raw: bytes, *types: type) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    sizes = [np.dtype(t).itemsize for t in types]
    n, at, out = len(data) // sum(sizes), 0, []
    for t, k in zip(types, sizes, strict=True):
        out.append(np.ascontiguousarray(data[at : at + n * k].reshape(k, n).T).reshape(-1).view(t) if n else np.zeros(0, t))
        at += n * k
    return out


_MESSAGE = "shard int, kind int, block long, data binary"


def _sent(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    shard, kind, block, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["shard", "kind", "block", "data"])


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its entries in their order) of each shard that has entries."""
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for k in range(shards):
        if ends[k + 1] > ends[k]:
            yield k, order[ends[k] : ends[k + 1]]


def _dealt(df: DataFrame, shards: int) -> DataFrame:
    return df.repartitionById(shards, F.col("shard"))


def _held(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], list[tuple[int, bytes]]]:
    """A partition's messages, (block, data), by shard and kind."""
    out: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for batch in batches:
        for shard, kind, block, data in zip(batch["shard"].to_pylist(), batch["kind"].to_pylist(), batch["block"].to_pylist(), batch["data"].to_pylist(), strict=True):
            out.setdefault((shard, kind), []).append((block, data))
    return out


#: What a worker has made of the model's arrays, for the next task in it; at most so many things.
_MADE: dict[tuple, object] = {}
_MOST_MADE = 6


def _made(make: Callable[[], object], *arrays: np.ndarray):
    """``make()``, or what it gave for equal arrays before in this worker."""
    key = (make.__qualname__, *((len(x), hash(x.tobytes())) for x in arrays))
    if key not in _MADE:
        while len(_MADE) >= _MOST_MADE:
            _MADE.pop(next(iter(_MADE)))
        _MADE[key] = make()
    return _MADE[key]


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them: what goes to tasks is kept small."""
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


class Head:
    """The most frequent words and the end token, by falling count: hashes and counts.  A word's place is its rank."""

    def __init__(self, words: np.ndarray, count: np.ndarray):
        self.words, self.small = words, _small(count)

    @property
    def count(self) -> np.ndarray:
        return self.small.astype(np.int64)

    def __len__(self) -> int:
        return len(self.words)

    def ready(self) -> Head:
        """With its finder, which a task makes for itself."""

        def make() -> Head:
            out = Head(self.words, self.small)
            out.order = np.argsort(self.words)
            out.find = Finder(self.words[out.order])
            out.named = np.concatenate([self.words, np.zeros(1, np.uint64)])
            return out

        return _made(make, self.words, self.small)

    def ranks(self, stream: np.ndarray) -> np.ndarray:
        """The rank of each word, or -1."""
        at = self.find(stream)
        return np.where(at >= 0, self.order[at] if len(self) else 0, -1)

    def coded(self, stream: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a number for each word: its rank, or for one outside a number of this stream's own; the hashes by number)."""
        outside = rank < 0
        own, of = np.unique(stream[outside], return_inverse=True)
        code = rank.astype(np.int64)
        code[outside] = len(self) + of
        return code, np.concatenate([self.named[:-1], own])

    def sent(self, code: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers for a message, where all words outside have one; the hashes of those outside, in order)."""
        return np.minimum(code, len(self)).astype(np.uint32), named[code[code >= len(self)]]

    def received(self, code: np.ndarray, outside: np.ndarray) -> np.ndarray:
        out = self.named[code]
        out[code == len(self)] = outside
        return out


class Pairs:
    """The hot pairs: their words' ranks as one number each (rank * width + rank), and counts."""

    def __init__(self, width: int, code: np.ndarray, n: np.ndarray):
        self.width, self.small, self.small_n = width, _small(code), _small(n)

    code = property(lambda self: self.small.astype(np.int64))
    n = property(lambda self: self.small_n.astype(np.int64))
    u = property(lambda self: self.code // self.width)
    w = property(lambda self: self.code % self.width)

    def ready(self, head: Head) -> Pairs:
        """By ascending key, with the keys, which a task makes for itself."""

        def make() -> Pairs:
            keys = pair_keys(head.named[self.u], head.named[self.w])
            order = np.argsort(keys)
            out = Pairs(self.width, self.small[order], self.small_n[order])
            out.keys = keys[order]
            out.find = Finder(out.keys)
            return out

        return _made(make, np.array([self.width]), self.small, self.small_n, head.words)


#: Bits of a word's number in one task's stream: the head's ranks and the words outside it.
_CODE = 21


class _Stream:
    """The tokens of several texts in a row, each text after an end token: hashes, ranks, and where texts begin."""

    def __init__(self, head: Head):
        self.head, self.size = head, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.end = head.ranks(np.array([END], np.uint64))

    def add(self, stream: np.ndarray, first: np.ndarray, rank: np.ndarray) -> None:
        opens = first[:-1] + np.arange(len(first) - 1)
        inside = np.ones(len(stream) + len(opens), bool)
        inside[opens] = False
        words, ranks = np.full(len(inside), END, np.uint64), np.full(len(inside), self.end[0], np.int64)
        words[inside], ranks[inside] = stream, rank
        self.parts.append((words, ranks, inside))
        self.size += len(words)

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of the tokens, hashes by number, whether a token is a text's own), and an empty stream again."""
        words, rank, inside = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        code, named = self.head.coded(words, rank)
        return code, named, inside


def _grams(order: int, head: Head, shards: int, pairs: Pairs | None = None):
    """Messages with a task's distinct 2- or 3-grams and their counts; pairs: the hot ones.

    A triple goes to the shard of its first two words, those with a hot pair there (kind 1) to its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = head.ready()
        held = pairs.ready(own).find if pairs else None
        tokens = _Stream(own)

        def flush() -> Iterator[pa.RecordBatch]:
            if not tokens.size:
                return
            code, named, inside = tokens.taken()
            ends = np.flatnonzero(inside)
            if order == 3:
                ends = ends[inside[ends - 1]]
            gram = np.zeros(len(ends), np.int64)
            for k in range(order - 1, -1, -1):
                gram = gram << _CODE | code[ends - k]
            gram, n = np.unique(gram, return_counts=True)
            mask = (1 << _CODE) - 1
            words = [gram >> (_CODE * k) & mask for k in range(order - 1, -1, -1)]
            by = pair_keys(named[words[0]], named[words[1]])
            hot = np.zeros(len(by), np.int64)
            if order == 3:
                at = np.flatnonzero(held(by) >= 0)
                hot[at] = 1
                by[at] = triple_keys(named[words[0][at]], pair_keys(named[words[1][at]], named[words[2][at]]))
            rows = []
            for k, at in _by_shard((by % np.uint64(shards)).astype(np.int64) * 2 + hot, 2 * shards):
                sent = [own.sent(w[at], named) for w in words]
                steps = np.diff(sent[0][0], prepend=np.uint32(0))
                rows.append((k // 2, k % 2, len(at), b"".join(_framed(_message(n[at].astype(np.uint32), steps, *(c for c, _ in sent[1:])), *(_message(x) for _, x in sent)))))
            if rows:
                yield _sent(rows)

        for batch in batches:
            for _, _, data, offsets in kernel.blocks(batch["text"]):
                stream, first = token_stream(data, offsets)
                tokens.add(stream, first, own.ranks(stream))
                if tokens.size > HELD:
                    yield from flush()
        yield from flush()

    return run


def _framed(*parts: bytes) -> Iterator[bytes]:
    for p in parts:
        yield len(p).to_bytes(8, "little")
        yield p


def _unframed(raw: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(raw[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _gathered(order: int, head: Head, got: list[tuple[int, bytes]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(n, the words) of the distinct n-grams in messages."""
    ns, columns = [np.zeros(0, np.uint32)], [[np.zeros(0, np.uint64)] for _ in range(order)]
    for _, raw in got:
        body, *outside = _unframed(raw)
        n, *codes = _received(body, *[np.uint32] * (order + 1))
        codes[0] = np.cumsum(codes[0], dtype=np.uint32)
        ns.append(n)
        for k, (code, x) in enumerate(zip(codes, outside, strict=True)):
            columns[k].append(head.received(code, *_received(x, np.uint64)))
    n, words = np.concatenate(ns).astype(np.int64), [np.concatenate(c) for c in columns]
    suf = pair_keys(words[-2], words[-1])
    _, at, n = _grouped(suf if order == 2 else triple_keys(words[0], suf), n)
    return n, [w[at] for w in words]


_TWO = "key long, pre long, suf long, n long, n_pre long, n_suf long, u int, w int"


def _counted_pairs(head: Head, conf: Orders):
    """The pairs that the model keeps; n_pre, n_suf: their words' counts, null outside the head; u, w: their ranks where both are hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = head.ready()
        for _, got in sorted(_held(batches).items()):
            n, (u, w) = _gathered(2, own, got)
            keep = n >= conf.least
            n, u, w = n[keep], u[keep], w[keep]
            ranks = [own.ranks(u), own.ranks(w)]
            counts = [pa.array(own.count[r] if len(own) else r, mask=r < 0) for r in ranks]
            hot = (ranks[0] >= 0) & (ranks[1] >= 0) & (ranks[0] < conf.pairs) & (ranks[1] < conf.pairs)
            cols = [pa.array(x.view(np.int64)) for x in (pair_keys(u, w), u, w)] + [pa.array(n), *counts, *(pa.array(r.astype(np.int32), mask=~hot) for r in ranks)]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "pre", "suf", "n", "n_pre", "n_suf", "u", "w"])

    return run


_THREE = "key long, pre long, suf long, n long, p double, p2 double, u int, v int, w int"


def _counted_triples(head: Head, pairs: Pairs, conf: Orders):
    """The triples that the model keeps, with p; p2: of their last two words, null unless these are hot.

    Every occurrence of a pair but at a text's end is in a triple, and an end
    is no history: so a history's count is the sum over its triples.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = head.ready()
        hot_pairs = pairs.ready(own)
        find = hot_pairs.find
        for (_, hot), got in sorted(_held(batches).items()):
            n, (u, v, w) = _gathered(3, own, got)
            keep = n >= conf.least
            if hot:
                u, v, w, n = u[keep], v[keep], w[keep], n[keep]
                pre = pair_keys(u, v)
                total = hot_pairs.n[find(pre)]
            else:
                pre = pair_keys(u, v)
                by = np.argsort(pre)
                new = np.concatenate([[True], pre[by][1:] != pre[by][:-1]])[: len(by)]
                total = np.empty(len(n), np.int64)
                total[by] = np.add.reduceat(n[by], np.flatnonzero(new))[np.cumsum(new) - 1] if len(by) else n
                u, v, w, n, pre, total = (x[keep] for x in (u, v, w, n, pre, total))
            suf = pair_keys(v, w)
            last = find(suf)
            ranks = [own.ranks(x) for x in (u, v, w)]
            inside = np.all([(r >= 0) & (r < conf.triples) for r in ranks], axis=0)
            p_hot = (hot_pairs.n - conf.discount) / own.count[hot_pairs.u] if len(hot_pairs.n) else np.zeros(1)
            p2 = pa.array(p_hot[last], mask=last < 0)
            cols = [pa.array(x.view(np.int64)) for x in (triple_keys(u, suf), pre, suf)] + [pa.array(n), pa.array((n - conf.discount) / total), p2, *(pa.array(r.astype(np.int32), mask=~inside) for r in ranks)]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "pre", "suf", "n", "p", "p2", "u", "v", "w"])

    return run


class Automaton:
    """State 0 is the root, 1 + w the word of rank w, then the kept pairs in the order of their keys (rank * width + rank).

    A state without an arc for a word adds ``back`` and goes on at ``fail``; ``down`` is all of it to the root.
    """

    def __init__(self, width: int, one: np.ndarray, two: np.ndarray, log2: np.ndarray, three: np.ndarray, log3: np.ndarray, back: np.ndarray):
        """one: words' log weights by rank; two: pairs' keys, ascending; three: (place of the pair) * width + rank, ascending."""
        self.width, self.one, self.two, self.log2, self.three, self.log3, self.back = width, one, two, log2, three, log3, back
        self.fail = np.concatenate([np.zeros(len(one) + 1, np.int64), 1 + two % width])
        self.down = self.back + np.where(self.fail > 0, self.back[self.fail], 0.0)
        self.down[0] = 0.0
        spread = lambda x: kernel.mix(x.astype(np.uint64))
        self._spread = spread
        self._order2, self._order3 = np.argsort(spread(two)), np.argsort(spread(three))
        self._find2, self._find3 = Finder(spread(two)[self._order2]), Finder(spread(three)[self._order3])

    def _pair(self, x: np.ndarray) -> np.ndarray:
        at = self._find2(self._spread(x))
        return np.where(at >= 0, self._order2[at] if len(self.two) else 0, -1)

    def _triple(self, x: np.ndarray) -> np.ndarray:
        at = self._find3(self._spread(x))
        return np.where(at >= 0, self._order3[at] if len(self.three) else 0, -1)

    def traverse(self, words: list[int], state: int) -> float:
        """log10 weight of a sequence of ranks from a state; a word outside counts only the way down to the root."""
        total = 0.0
        for w in words:
            if w >= self.width:
                total, state = total + float(self.down[state]), 0
                continue
            while True:
                if state == 0:
                    total, state = total + float(self.one[w]), 1 + w
                    break
                if state <= len(self.one):
                    at = int(self._pair(np.array([(state - 1) * self.width + w]))[0])
                    weight, after = (float(self.log2[at]), 1 + len(self.one) + at) if at >= 0 else (None, 0)
                else:
                    at = int(self._triple(np.array([(state - 1 - len(self.one)) * self.width + w]))[0])
                    pair = int(self._pair(np.array([int(self.fail[state] - 1) * self.width + w]))[0]) if at >= 0 else -1
                    weight, after = (float(self.log3[at]), 1 + len(self.one) + pair if pair >= 0 else 1 + w) if at >= 0 else (None, 0)
                if weight is not None:
                    total, state = total + weight, after
                    break
                total, state = total + float(self.back[state]), int(self.fail[state])
        return total

    def weights(self, rank: np.ndarray, first: np.ndarray, opens: int) -> tuple[np.ndarray, np.ndarray]:
        """(log10 weight, length of the n-gram whose arc was taken) of every word of texts of ranks; ``width`` and more: outside.

        opens: the rank that stands before each text.
        """
        n1 = len(self.one)
        inside = rank < self.width
        before = _before(rank, first, rank, opens)
        both = inside & (before < self.width)
        pair = np.full(len(rank), -1, np.int64)
        pair[both] = self._pair(before[both] * self.width + rank[both])
        # The state before a word: the pair of the two words before it, else the word before it, else the root.
        came = _before(rank, first, pair, -1)
        state = np.where(came >= 0, 1 + n1 + came, np.where(before < self.width, 1 + before, 0))
        triple = np.full(len(rank), -1, np.int64)
        ask = np.flatnonzero(inside & (came >= 0))
        triple[ask] = self._triple(came[ask] * self.width + rank[ask])
        third, second = triple >= 0, pair >= 0
        own = np.where(third, self.log3[triple] if len(self.log3) else 0.0, np.where(second, self.log2[pair] if len(self.log2) else 0.0, np.where(inside, self.one[np.where(inside, rank, 0)] if n1 else 0.0, 0.0)))
        fell = np.where(third, 0.0, np.where(second, np.where(came >= 0, self.back[state], 0.0), self.down[state]))
        return own + fell, np.where(third, 3, np.where(second, 2, np.where(inside, 1, 0)))


def build(unigram: np.ndarray, two: dict[int, int], three: dict[int, int], total: int, d1: float, conf: Orders, backs: tuple[np.ndarray, np.ndarray] | None = None) -> Automaton:
    """unigram: counts by rank of the words that n-grams may hold; two, three: kept n-grams' counts.

    backs: backoff weights by word and by ascending pair, if these n-grams are a part of a larger model.
    """
    arrays = lambda d: (np.array(sorted(d), np.int64), np.array([d[k] for k in sorted(d)], float))
    return _built(unigram, *arrays(two), *arrays(three), total, d1, conf, backs)


def _built(unigram: np.ndarray, two: np.ndarray, n2: np.ndarray, three: np.ndarray, n3: np.ndarray, total: int, d1: float, conf: Orders, backs: tuple[np.ndarray, np.ndarray] | None) -> Automaton:
    width, n = conf.pairs, len(unigram)
    p1 = (unigram - d1) / total
    h, w = two // width, two % width
    p2 = (n2 - conf.discount) / unigram[h] if len(two) else np.zeros(0)
    place = lambda keys: np.minimum(np.searchsorted(two, keys), max(len(two) - 1, 0))
    uv, x = three // conf.triples, three % conf.triples
    pre = uv // conf.triples * width + uv % conf.triples
    held = two[place(pre)] == pre if len(two) else np.zeros(len(three), bool)
    x, pre, v, n3 = x[held], place(pre[held]), (uv % conf.triples)[held], n3[held]
    p3 = (n3 - conf.discount) / n2[pre] if len(pre) else np.zeros(0)
    back = np.zeros(1 + n + len(two))
    rest = lambda kept, below: np.log10(np.maximum(1 - kept, 1e-9) / np.maximum(1 - below, 1e-9))
    kept = np.bincount(h, weights=p2, minlength=n)[:n]
    back1 = np.where(kept > 0, rest(kept, np.bincount(h, weights=p1[w], minlength=n)[:n]), 0.0) if len(two) else np.zeros(n)
    if backs:
        back[1 : n + 1], back[n + 1 :] = backs[0][:n], backs[1]
    else:
        back[1 : n + 1] = back1
        if len(pre):
            suf = v * width + x
            known = two[place(suf)] == suf
            below = np.where(known, p2[place(suf)], 10 ** back1[v] * p1[x])
            kept2 = np.bincount(pre, weights=p3, minlength=len(two))
            back[n + 1 :] = np.where(kept2 > 0, rest(kept2, np.bincount(pre, weights=below, minlength=len(two))), 0.0)
    arcs = pre * width + x
    order = np.argsort(arcs)
    with np.errstate(divide="ignore"):
        return Automaton(width, np.log10(p1), two, np.log10(p2), arcs[order], np.log10(p3)[order], back)


@dataclass
class Model:
    table: DataFrame  # messages to the shards with what each word outside the head and each kept 2- and 3-gram adds, stored
    total: int
    distinct: int
    d1: float
    shards: int
    head: Head
    back: np.ndarray  # the head's backoff weights, by rank
    hot: Pairs  # the 2-grams that tasks hold
    back2: np.ndarray  # their backoff weights
    three: dict[int, int]  # the 3-grams that tasks hold

    @property
    def count(self) -> np.ndarray:
        return self.head.count

    @property
    def two(self) -> dict[int, int]:
        return dict(zip(self.hot.code.tolist(), self.hot.n.tolist(), strict=True))


def _cutoff(counts: DataFrame, most: int) -> int:
    """The least count c such that at most ``most`` rows have n >= c."""
    steps = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("rows")).collect()
    kept, cut = 0, 100_001
    for r in sorted(steps, key=lambda r: -r["n"]):
        if kept + r["rows"] > most:
            break
        kept, cut = kept + r["rows"], r["n"]
    return cut


def _log_ratio(kept: str, below: str):
    rest = lambda c: F.greatest(1 - F.sum(c), F.lit(1e-9))
    return F.log10(rest(kept) / rest(below))


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    """A bounded table's columns in the driver, by ascending unsigned key."""
    got = df.toArrow()
    out = {c: got[c].to_numpy() for c in got.column_names}
    order = np.argsort(out["key"].view(np.uint64))
    return {c: x[order] for c, x in out.items()}


def fit(train: DataFrame, conf: Orders = Orders()) -> Model:
    """Count every word, 2- and 3-gram of every training text; n-grams are kept from ``least`` times on.

    Null texts are empty ones, repeated rows count as often as they occur, ids
    and further columns are not read, texts of any length are counted whole.
    Without rows the model knows no word.
    """
    spark, col, texts = train.sparkSession, F.col, train.select("text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = shared.stored(_dealt(texts.mapInArrow(_words(parts), _MESSAGE), parts).mapInArrow(_counted_words, "key long, n long"), "counted", ("key",))
    s = counted.agg(F.sum("n").alias("total"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    total, distinct = s["total"] or 0, s["v"]
    d1 = float(np.clip(s["n1"] / max(1, s["n1"] + 2 * s["n2"]), 0.1, 0.95))
    shards = max(parts, -(-total // SHARD_TOKENS))
    got = _columns(counted.filter((col("n") >= _cutoff(counted, conf.head)) | (col("key") == _signed(END))))
    words, count = got["key"].view(np.uint64), got["n"]
    by_rank = np.lexsort((words, -count))
    head = Head(words[by_rank], count[by_rank])
    ready = head.ready()

    # Pairs, their probabilities p and those of their last words p1.
    counts = _dealt(texts.mapInArrow(_grams(2, head, shards), _MESSAGE), shards).mapInArrow(_counted_pairs(head, conf), _TWO)
    first = shared.stored(counts, "two", ("key", "pre", "suf"))
    apart = first.filter("n_pre is null or n_suf is null").drop("n_pre", "n_suf")
    # Sides with one row a key are hashed, a partition at a time, instead of sorting both.
    n_of = lambda c: counted.select(col("key").alias(c), col("n").alias(f"n_{c}")).hint("shuffle_hash")
    apart = shared.stored(apart.join(n_of("pre"), "pre").join(n_of("suf"), "suf").select(*first.columns), "apart")
    shares = lambda df: df.select("*", ((col("n") - conf.discount) / col("n_pre")).alias("p"), ((col("n_suf") - d1) / float(max(total, 1))).alias("p1"))
    beside, apart_two = shares(first.filter("n_pre is not null and n_suf is not null")), shares(apart)
    two = beside.unionByName(apart_two)
    hot = shared.stored(two.filter("u is not null").select("key", "u", "w", "n"), "hot")
    got = _columns(hot.filter(col("n") >= _cutoff(hot, conf.grams)))
    shared.drop(hot)
    pairs = Pairs(conf.pairs, got["u"].astype(np.int64) * conf.pairs + got["w"], got["n"])

    # Words: their weight and their backoff weight.
    back1 = two.groupBy("pre").agg(_log_ratio("p", "p1").alias("back"))
    one = counted.join(back1.withColumnRenamed("pre", "key").hint("shuffle_hash"), "key", "left").withColumn("back", F.coalesce("back", F.lit(0.0)))
    one = shared.stored(one.select("key", "n", "back", (F.log10((col("n") - d1) / float(max(total, 1))) + col("back")).alias("value")), "words", ("key",))
    shared.drop(counted)
    inside = spark.createDataFrame(pa.table({"key": pa.array(words.view(np.int64))}))
    of_head = _columns(one.join(F.broadcast(inside), "key").select("key", "back"))["back"]

    # Triples, and the backoff weights of pairs.
    counts = _dealt(texts.mapInArrow(_grams(3, head, shards, pairs), _MESSAGE), shards).mapInArrow(_counted_triples(head, pairs, conf), _THREE)
    first3 = shared.stored(counts, "three", ("key", "pre", "suf"))
    cold = first3.filter("p2 is null").select("key", "pre", "suf", "p")
    rest = shared.stored(cold.join(two.select(col("key").alias("suf"), col("p").alias("p2")).hint("shuffle_hash"), "suf").select("key", "pre", "suf", "p", "p2"), "rest", ("key", "pre", "suf"))
    three = first3.filter("p2 is not null").select("key", "pre", "suf", "p", "p2").unionByName(rest)
    back2 = shared.stored(three.groupBy("pre").agg(_log_ratio("p", "p2").alias("back")), "back2", ("pre", "back"))

    # What a word, pair or triple adds: pairs and triples what they change against backing off at their place; words and pairs their backoff weight as well.
    triples = three.join(back2.hint("shuffle_hash"), "pre").select("key", "suf", (F.log10("p") - col("back") - F.log10("p2")).alias("value"))
    near = F.broadcast(spark.createDataFrame(pa.table({"pre": pa.array(words.view(np.int64)), "back1": pa.array(of_head)})))
    own = ("key", "p", "p1", "back1")
    other = apart_two.join(one.select(col("key").alias("pre"), col("back").alias("back1")).hint("shuffle_hash"), "pre")
    valued = beside.join(near, "pre").select(*own).unionByName(other.select(*own)).join(back2.withColumnRenamed("pre", "key").hint("shuffle_hash"), "key", "left")
    valued = valued.select("key", (F.log10("p") - col("back1") - F.log10("p1") + F.coalesce("back", F.lit(0.0))).alias("value"))
    outside = one.join(F.broadcast(inside), "key", "left_anti").select("key", "value", "n")
    parts = [df.mapInArrow(_table_messages(kind, shards, *((head, pairs) if kind == _TRIPLES else (None, None))), _MESSAGE) for kind, df in ((_WORDS, outside), (_PAIRS, valued), (_TRIPLES, triples))]
    stored = [shared.stored(p, "model") for p in parts]
    table = stored[0].unionByName(stored[1]).unionByName(stored[2])

    keys = pairs.ready(ready).keys
    held = spark.createDataFrame(pa.table({"key": pa.array(keys.view(np.int64))}))
    got = _columns(back2.withColumnRenamed("pre", "key").join(F.broadcast(held), "key"))
    back_of = np.zeros(len(keys))
    back_of[np.searchsorted(keys, got["key"].view(np.uint64))] = got["back"]
    three_hot = _hot_triples(first3, pairs, conf)
    shared.drop(first, apart, first3, rest, back2, one)
    return Model(table, total, distinct, d1, shards, head, of_head[by_rank], pairs, back_of, three_hot)


def _hot_triples(triples: DataFrame, pairs: Pairs, conf: Orders) -> dict[int, int]:
    """The 3-grams that tasks hold, by ranks; only beside both of their pairs."""
    u, w = pairs.u, pairs.w
    near = (u < conf.triples) & (w < conf.triples)
    table = pa.table({"u": pa.array(u[near].astype(np.int32)), "v": pa.array(w[near].astype(np.int32))})
    known = F.broadcast(triples.sparkSession.createDataFrame(table))
    both = triples.filter("u is not null").join(known, ["u", "v"]).join(known.select(F.col("u").alias("v"), F.col("v").alias("w")), ["v", "w"]).select("u", "v", "w", "n")
    both = shared.stored(both, "hot")
    got = both.filter(F.col("n") >= _cutoff(both, conf.grams)).toArrow()
    shared.drop(both)
    u, v, w = (got[c].to_numpy().astype(np.int64) for c in "uvw")
    return dict(zip(((u * conf.triples + v) * conf.triples + w).tolist(), got["n"].to_pylist(), strict=True))


# Kinds of messages while scoring: the model's words, pairs and triples; asked: words, pairs with the word before them, triples; and documents.
_WORDS, _PAIRS, _TRIPLES, _ASK_WORDS, _ASK_PAIRS, _ASK_TRIPLES, _DOCUMENTS = range(7)


def _table_messages(kind: int, shards: int, head: Head | None, pairs: Pairs | None):
    """The model's rows to their shards: words and pairs by their key, triples by their last two words, or by themselves where these are hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pairs.ready(head.ready()).find if pairs else None
        parts, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if parts:
                of, *columns = (np.concatenate(x) for x in zip(*parts, strict=True))
                parts.clear()
                order = np.argsort(columns[0])
                of, columns = of[order], [c[order] for c in columns]
                yield _sent([(shard, kind, 0, _message(np.diff(columns[0][at], prepend=np.uint64(0)), *(c[at] for c in columns[1:]))) for shard, at in _by_shard((of % np.uint64(shards)).astype(np.int64), shards)])

        for batch in batches:
            key = batch["key"].to_numpy().view(np.uint64)
            of = key
            if kind == _TRIPLES:
                suf = batch["suf"].to_numpy().view(np.uint64)
                of = np.where(held(suf) >= 0, key, suf)
            more = [batch["n"].to_numpy()] if kind == _WORDS else []
            if len(key):
                parts.append((of, key, batch["value"].to_numpy(), *more))
                size += len(key)
            if size > HELD:
                yield from flush()
                size = 0
        yield from flush()

    return run


@dataclass
class _Scale:
    """Tokens and distinct words of the training texts, what is taken off a word's count, and what is added for the base score."""

    total: int
    distinct: int
    d1: float
    smoothing: float

    @property
    def unknown(self) -> tuple[float, float]:
        """log10 of an unknown word's base share and of its weight."""
        share = self.d1 * self.distinct / self.total if self.total else 1.0
        return float(np.log10(self.smoothing / self.whole)), float(np.log10(share))

    @property
    def whole(self) -> float:
        return self.total + self.smoothing * (self.distinct + 1)


@dataclass
class _Part:
    """What every task needs of a model."""

    head: Head
    back: np.ndarray
    hot: Pairs
    back2: np.ndarray
    three: np.ndarray
    n3: np.ndarray
    scale: _Scale
    shards: int
    conf: Orders

    def automaton(self) -> Automaton:
        """Of the hot part; its words are those of the least ranks, its pairs in the order of their ranks."""

        def make() -> Automaton:
            n = min(self.conf.pairs, len(self.head))
            unigram = self.head.count[:n].astype(float)
            hot = self.hot.ready(self.head.ready())
            key = hot.code
            order = np.argsort(key)
            return _built(unigram, key[order], hot.n[order].astype(float), self.three.astype(np.int64), self.n3.astype(float), max(self.scale.total, 1), self.scale.d1, self.conf, (self.back, self.back2[order]))

        figures = np.array([self.scale.total, self.scale.d1, self.conf.pairs, self.conf.triples, self.conf.discount])
        return _made(make, figures, self.head.words, self.head.small, self.hot.small, self.hot.small_n, self.back, self.back2, self.three, self.n3)


def _traversed(part: _Part):
    """Messages of a task's documents: what the automaton gives them, and what it has to ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, conf, shards = TaskContext.get().partitionId() << 32, part.conf, part.shards
        automaton, head = part.automaton(), part.head.ready()
        count = head.count
        base_of = np.log10((count + conf.smoothing) / part.scale.whole)
        rest_of = np.where(np.arange(len(count)) < conf.pairs, 0.0, np.log10((count - part.scale.d1) / max(part.scale.total, 1)) + part.back)
        end = int(head.ranks(np.array([END], np.uint64))[0]) if len(count) else -1
        outside_base, outside = part.scale.unknown
        far = 1 << 30
        docs: list[tuple[np.ndarray, ...]] = []
        words: list[tuple[np.ndarray, ...]] = []
        tokens, grams = _Stream(head), []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block
            out = []
            if docs:
                out.append((((block >> 32) + block) % (1 << 32) % shards, _DOCUMENTS, block, _message(*(np.concatenate(x) for x in zip(*docs, strict=True)))))
            if words:
                word, doc = (np.concatenate(x) for x in zip(*words, strict=True))
                for shard, at in _by_shard((word % np.uint64(shards)).astype(np.int64), shards):
                    order = at[np.argsort(word[at])]
                    out.append((shard, _ASK_WORDS, block, _message(np.diff(word[order], prepend=np.uint64(0)), doc[order])))
            if tokens.size:
                code, named, inside = tokens.taken()
                doc, arc = (np.concatenate(x) for x in zip(*grams, strict=True))
                at = np.flatnonzero(inside)
                # A cold pair is asked for with the word before it: a triple is kept only beside its pairs.  Before an opening word there is none; the end token stands for it.
                third = inside[at - 1]
                for kind, ask in ((_ASK_PAIRS, arc < 2), (_ASK_TRIPLES, (arc == 2) & third)):
                    ends, of = at[ask], doc[ask]
                    before = np.where(third[ask], code[ends - 2], code[ends - 1])
                    v, w = code[ends - 1], code[ends]
                    key = pair_keys(named[v], named[w])
                    if kind == _ASK_TRIPLES:
                        key = triple_keys(named[before], key)
                    shard = (key % np.uint64(shards)).astype(np.int64)
                    order = np.argsort(shard << (2 * _CODE) | v << _CODE | w)
                    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                    for k in np.flatnonzero(np.diff(cuts)).tolist():
                        o = order[cuts[k] : cuts[k + 1]]
                        sent = [own for own in (head.sent(x[o], named) for x in (v, w, before))]
                        steps = np.diff(sent[0][0], prepend=np.uint32(0))
                        out.append((k, kind, block, b"".join(_framed(_message(steps, sent[1][0], sent[2][0], of[o]), *(_message(x) for _, x in sent)))))
            for x in (docs, words, grams):
                x.clear()
            block += 1
            if out:
                yield _sent(out)

        for batch in batches:
            ids, given = batch["doc_id"].cast(pa.int64()), np.asarray(batch["doc_id"].is_valid())
            ids = ids.fill_null(0).to_numpy()
            for lo, hi, data, offsets in kernel.blocks(batch["text"]):
                stream, first = token_stream(data, offsets)
                rank = head.ranks(stream)
                known = rank >= 0
                weight, arc = automaton.weights(np.where(known, rank, far), first, end if end >= 0 else far)
                per = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731, B023
                at = np.where(known, rank, 0)
                base = per(np.where(known, base_of[at] if len(count) else 0.0, outside_base))
                score = per(weight + np.where(known, rest_of[at] if len(count) else 0.0, outside))
                docs.append((ids[lo:hi], given[lo:hi], np.diff(first), per(known.astype(np.int64)), base, score))
                doc = np.repeat(np.arange(rows, rows + hi - lo, dtype=np.uint32), np.diff(first))
                rows += hi - lo
                words.append((stream[~known], doc[~known]))
                tokens.add(stream, first, rank)
                grams.append((doc, arc.astype(np.int8)))
                if tokens.size > HELD:
                    yield from flush()
                    rows = 0
        yield from flush()

    return run


def _merged(kind: int, got: dict, shard: int, *types: type) -> list[np.ndarray]:
    parts = [_received(raw, *types) for _, raw in got.get((shard, kind), [])]
    for x in parts:
        x[0] = np.cumsum(x[0], dtype=np.uint64)
    out = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, t) for t in types]
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _answers(head: Head, scale: _Scale):
    """For each block, the documents that a shard of the model adds something to, and how much; documents pass through."""

    def finder(keys: np.ndarray):
        find = Finder(keys)

        def found(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = find(x)
            hit = np.flatnonzero(at >= 0)
            return hit, at[hit]

        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, own = _held(batches), head.ready()
        for shard in sorted({s for s, _ in got}):
            words, word_value, word_n = _merged(_WORDS, got, shard, np.uint64, np.float64, np.int64)
            pairs, pair_value = _merged(_PAIRS, got, shard, np.uint64, np.float64)
            triples, triple_value = _merged(_TRIPLES, got, shard, np.uint64, np.float64)
            found_words, found_pairs, found_triples = finder(words), finder(pairs), finder(triples)
            outside_base, outside = scale.unknown
            base_of = np.log10((word_n + scale.smoothing) / scale.whole) - outside_base
            for block, raw in got.get((shard, _DOCUMENTS), []):
                yield _sent([(0, _DOCUMENTS, block, raw)])
            sums: dict[int, list[tuple[np.ndarray, ...]]] = {}
            for block, raw in got.get((shard, _ASK_WORDS), []):
                step, doc = _received(raw, np.uint64, np.uint32)
                hit, at = found_words(np.cumsum(step, dtype=np.uint64))
                sums.setdefault(block, []).append((doc[hit], word_value[at] - outside, base_of[at], np.ones(len(hit))))
            for kind in (_ASK_PAIRS, _ASK_TRIPLES):
                for block, raw in got.get((shard, kind), []):
                    body, *outside_of = _unframed(raw)
                    *codes, doc = _received(body, np.uint32, np.uint32, np.uint32, np.uint32)
                    codes[0] = np.cumsum(codes[0], dtype=np.uint32)
                    v, w, before = (own.received(c, *_received(x, np.uint64)) for c, x in zip(codes, outside_of, strict=True))
                    key = pair_keys(v, w)
                    if kind == _ASK_PAIRS:
                        hit, at = found_pairs(key)
                        sums.setdefault(block, []).append((doc[hit], pair_value[at], np.zeros(len(hit)), np.zeros(len(hit))))
                        before, key, doc = before[hit], key[hit], doc[hit]
                    hit, at = found_triples(triple_keys(before, key))
                    sums.setdefault(block, []).append((doc[hit], triple_value[at], np.zeros(len(hit)), np.zeros(len(hit))))
            out = []
            for block, parts in sums.items():
                doc, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
                if len(doc):
                    named, of = np.unique(doc, return_inverse=True)
                    out.append((0, _WORDS, block, _message(named, *(np.bincount(of, weights=v) for v in values))))
            if out:
                yield _sent(out)

    return run


_RESULT = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for kind, block, data in zip(batch["kind"].to_pylist(), batch["block"].to_pylist(), batch["data"].to_pylist(), strict=True):
            blocks.setdefault(block, []).append((kind, data))
    for block in sorted(blocks):
        held = sorted(blocks.pop(block), key=lambda x: -x[0])  # the documents first
        ids, given, tokens, known, base, score = _received(held[0][1], np.int64, bool, np.int64, np.int64, np.float64, np.float64)
        known, base, score = known.copy(), base.copy(), score.copy()
        for _, raw in held[1:]:
            doc, g, b, k = _received(raw, np.uint32, np.float64, np.float64, np.float64)
            score[doc] += g
            base[doc] += b
            known[doc] += k.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~given), pa.array(tokens), pa.array(known), pa.array(base), pa.array(score)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def scored(docs: DataFrame, model: Model, conf: Orders = Orders()) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Null or empty text: the end token alone.  Null ids are kept, repeated rows
    and equal ids get results of their own, an empty table gives no rows; no
    further column is read.  Texts of any length are scored whole.  Without
    training text every token is unknown, and both scores take the smoothed
    share of one unknown word.  ``docs`` is to give the same rows in the same
    order when a part of it is computed anew, as a table does.
    """
    three = np.array(sorted(model.three), np.int64)
    scale, shards = _Scale(model.total, model.distinct, model.d1, conf.smoothing), model.shards
    part = _Part(model.head, model.back, model.hot, model.back2, _small(three), _small(np.array([model.three[k] for k in three.tolist()], np.int64)), scale, shards, conf)
    own, out = shared.own_columns(docs, "doc_id", "text"), None
    for k in range(conf.rounds):
        some = own.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(conf.rounds)) == k)
        messages = some.mapInArrow(_traversed(part), _MESSAGE).unionByName(model.table)
        answers = _dealt(messages, shards).mapInArrow(_answers(model.head, scale), _MESSAGE)
        done = shared.stored(answers.repartition("block").mapInArrow(_summed, _RESULT), "scores")
        out = done if out is None else out.unionByName(done)
    return out.select("doc_id", "n_tokens", "n_known", F.lit(int(model.total)).cast("long").alias("train_tokens"), "base_score", "score")
