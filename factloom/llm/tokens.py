"""Token ids of whole texts by the tokenizers library, with chunks between spaces remembered."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from . import kernel

#: Chunks that a worker remembers; beyond, it starts anew.
REMEMBERED = 1 << 21


class Store:
    """Ids of chunks by the chunks' 64-bit hashes: open addressing in flat arrays, looked up a block at a time."""

    def __init__(self, remembered: int = REMEMBERED):
        self.most = remembered
        self.clear()

    def clear(self) -> None:
        self.mask = np.uint64(2 * self.most - 1)
        self.key, self.place = np.zeros(2 * self.most, np.uint64), np.zeros(2 * self.most, np.int32)
        self.n, self.end, self.ids = 0, np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        slot, left = hashes & self.mask, np.arange(len(hashes))
        while len(left):
            there = self.key[slot[left]]
            same = there == hashes[left]
            out[left[same]] = self.place[slot[left[same]]]
            left = left[~same & (there != 0)]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
        return out

    def add(self, hashes: np.ndarray, ids: list[np.ndarray]) -> None:
        """New distinct hashes with their ids."""
        index = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        slot, left = hashes & self.mask, np.arange(len(hashes))
        while len(left):
            free = left[self.key[slot[left]] == 0]
            self.key[slot[free]] = hashes[free]
            done = self.key[slot[left]] == hashes[left]
            self.place[slot[left[done]]] = index[left[done]]
            left = left[~done]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
        end = self.end[self.n] + np.cumsum([len(x) for x in ids])
        self.end, self.ids = _room(self.end, self.n + len(ids) + 1), _room(self.ids, int(end[-1]))
        self.ids[self.end[self.n] : end[-1]] = np.concatenate(ids)
        self.end[self.n + 1 : self.n + 1 + len(ids)] = end
        self.n += len(ids)

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many entries after each other, and the end of each."""
        begin = self.end[index]
        length = self.end[index + 1] - begin
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(begin - (ends - length), length)], ends


def _room(held: np.ndarray, n: int) -> np.ndarray:
    return held if len(held) >= n else np.concatenate([held, np.zeros(max(n, 2 * len(held)) - len(held), held.dtype)])


class Encoder:
    """For a tokenizer that drops white space: chunks between spaces and line ends are encoded alone.

    Every id comes from the library; chunks seen before are looked up by hash.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = self.library.get_added_tokens_decoder()
        self.mark = next(((t.content, i) for i, t in special.items() if t.special and not t.normalized and not (t.lstrip or t.rstrip or t.single_word)), None)
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        vocab = self.library.get_vocab(with_added_tokens=False)
        #: Ids that close a pre-token, where the vocabulary marks them.
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.closing = bool(self.ends.any())
        self.store = Store()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _together(self, groups: list[list[str]], between: str, cuts_of) -> Iterator[np.ndarray]:
        """Chunks that go through the library joined; cuts_of(group, ids) says where each chunk's ids end, or None."""
        for group, got in zip(groups, self.library.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False) if groups else [], strict=True):
            ids = np.array(got.ids, np.uint32)
            cuts = cuts_of(group, ids)
            if cuts is None:
                yield from map(self._ids, group)
            else:
                yield from (ids[a:b] for a, b in cuts)

    def _by_mark(self, group: list[str], ids: np.ndarray) -> list[tuple[int, int]]:
        at = np.flatnonzero(ids == self.mark[1]).tolist()
        return list(zip([0, *(i + 1 for i in at)], [*at, len(ids)], strict=True))

    def _by_word_ends(self, group: list[str], ids: np.ndarray) -> list[tuple[int, int]] | None:
        """A word is one pre-token and a full stop or comma after it a second; each ends with an id that closes a word."""
        ends = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1
        count = np.cumsum([1 if c.isalpha() else 2 for c in group])
        if len(ends) != count[-1]:
            return None
        at = ends[count - 1].tolist()
        return list(zip([0, *at[:-1]], at, strict=True))

    def _learn(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of new chunks.  Plain words go through the library joined by spaces, others that can't hold a special token by special tokens."""
        found: list[np.ndarray] = [None] * len(chunks)
        words, others = [], []
        for k, c in enumerate(chunks):
            if self.closing and max(c) < "\u0100" and (c.isalpha() or c[:-1].isalpha() and c[-1] in ".,"):
                words.append(k)
            elif self.mark is None or "<" in c:
                found[k] = self._ids(c)
            else:
                others.append(k)
        for at, between, cuts in ((words, " ", self._by_word_ends), (others, (self.mark or ("",))[0], self._by_mark)):
            groups = [[chunks[k] for k in at[i : i + 50]] for i in range(0, len(at), 50)]
            for k, ids in zip(at, self._together(groups, between, cuts), strict=True):
                found[k] = ids
        return found

    def blocks(self, column: pa.Array, end: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, first id of each row) a block of texts at a time; null is empty; ``end`` follows each text."""
        for lo, hi, data, offsets in kernel.blocks(column):
            words = kernel.Words(data, offsets)
            hashes = np.where(words.hash == 0, np.uint64(1), words.hash)
            index = self.store.find(hashes)
            new = np.flatnonzero(index < 0)
            if len(new):
                fresh, at = np.unique(hashes[new], return_index=True)
                if self.store.n + len(fresh) > self.store.most:
                    self.store = Store(max(self.store.most, 1 << len(hashes).bit_length()))
                    fresh, at = np.unique(hashes, return_index=True)
                    new = np.arange(len(hashes))
                raw = data.tobytes()
                at = new[at]
                self.store.add(fresh, self._learn([raw[a:b].decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]))
                index[new] = self.store.find(hashes[new])
            ids, ends = self.store.gather(index)
            first = np.concatenate([[0], ends])[words.first]
            if end is not None:
                ids = np.insert(ids, first[1:], end)
                first = first + np.arange(len(first))
            yield lo, hi, ids, first

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.column(pa.array(texts, pa.large_string()))

    def column(self, column: pa.Array, end: int | None = None) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out: list[bytes] = []
        for _, _, ids, first in self.blocks(column, end):
            raw, cuts = ids.astype("<u4").tobytes(), (4 * first).tolist()
            out += [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
