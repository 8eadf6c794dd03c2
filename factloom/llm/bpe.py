"""Byte-level BPE encoding and decoding over contiguous rank arrays.

A short word is held as a list of part ids beside a list of the ranks of
adjacent parts.  The least rank is found by a scan, its boundary is deleted,
and the two neighbouring ranks are refreshed.  A long word takes the same
merges in the same order from a heap, in n log n steps.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import kernel

#: Words of more parts than this take the heap.
SHORT = 96
#: Chunks that a worker remembers, twice at most; longer chunks are never remembered.
REMEMBERED = 500_000
LONGEST = 48
_NONE = 1 << 60

# The white space of Unicode, and the published pre-tokenizer's pattern over it.
_WS = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
_PATTERN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_TWO_SPACES = regex.compile(rf"[{_WS}][{_WS}]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        bytes_of = {c: b for b, c in letters.items()}
        self.single = [vocab[letters[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        tokens = {i: bytes(bytes_of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.length = np.array([len(t) for t in table], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def word(self, raw: bytes) -> list[int]:
        """Token ids of one pre-token."""
        parts = [self.single[b] for b in raw]
        if len(parts) > SHORT:
            return self._long(parts)
        find = self.merges.get
        ranks = [m[0] if (m := find(p)) else _NONE for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i] = self.merges[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = m[0] if (m := find((parts[i], parts[i + 1]))) else _NONE
            if i:
                ranks[i - 1] = m[0] if (m := find((parts[i - 1], parts[i]))) else _NONE
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m[0], i, p) for i, p in enumerate(zip(parts, parts[1:])) if (m := self.merges.get(p))]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = self.merges[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := self.merges.get(p := (parts[i], parts[after[i]])):
                    heapq.heappush(heap, (m[0], i, p))
            if (h := before[i]) >= 0 and (m := self.merges.get(p := (parts[h], parts[i]))):
                heapq.heappush(heap, (m[0], h, p))
        return [p for p in parts if p >= 0]

    def _plain(self, text: str) -> bytes:
        out: list[int] = []
        for word in _PATTERN.findall(text):
            out += self.word(word.encode())
        return np.array(out, np.int32).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Of a space and ``chunk``, remembered."""
        found = self.old.get(chunk)
        if found is None:
            found = self._plain(" " + chunk)
        if len(chunk) <= LONGEST:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[chunk] = found
        return found

    def _segment(self, text: str) -> bytes:
        """Where white space never stands twice, a space always opens a pre-token, so chunks between spaces are independent."""
        if not text or _TWO_SPACES.search(text):
            return self._plain(text)
        head, *rest = text.split(" ")
        known = list(map(self.young.get, rest))
        if None in known:
            known = [self._chunk(c) if k is None else k for c, k in zip(rest, known, strict=True)]
        return self._plain(head) + b"".join(known)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of special tokens become those tokens."""
        if self.cut is None or not any(s in text for s in self.special):
            return np.frombuffer(self._segment(text), np.int32)
        parts = self.cut.split(text)
        return np.frombuffer(b"".join(np.int32(self.special[p]).tobytes() if i % 2 else self._segment(p) for i, p in enumerate(parts)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens kept; bytes that are no UTF-8 become U+FFFD."""
        length = self.length[ids]
        end = np.cumsum(length)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.begin[ids] - (end - length), length)
        return self.flat[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            lo = 0
            _, offsets = kernel.text_buffers(batch["text"])
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + kernel.BLOCK_BYTES, "right")) - 1)
                part = batch.slice(lo, hi - lo)
                ids = [own.encode(t or "") for t in part["text"].to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), listed, pa.array([own.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])
                lo = hi

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row: the whole text's token ids, and the text decoded from them.

    ``path``: a byte-level BPE tokenizer.json that every executor can open.
    Null or empty text has no ids and decodes to the empty text.  Null ids are
    kept, repeated rows and rows with equal ids get results of their own text,
    texts of any length are encoded whole, further columns are not read, an
    empty table gives no rows.
    """
    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(_round_trip(path), "doc_id long, ids array<int>, decoded string")
