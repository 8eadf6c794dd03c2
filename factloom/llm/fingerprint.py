"""Document fingerprints: a quartile bucket digest.

Byte triplets of a sliding five-byte window are hashed into buckets and
counted.  The digest holds the text's length class, the ratios of the bucket
counts' quartiles, and for each bucket the quartile its count falls into.
Two digests are compared by a difference score that a bound cuts off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, ranges, shared


@dataclass(frozen=True)
class Digest:
    """bits: 2**bits buckets; far: the difference a bucket (0 to 6) of digests that have likeness 0."""

    bits: int = 8
    far: float = 2.0


_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
#: What two quartile codes add to the difference, by how far apart they are.
_APART = np.array([0, 1, 2, 6], dtype=np.int32)
_CHUNK = 1 << 17


def _counts(data: np.ndarray, bits: int) -> np.ndarray:
    """Bucket counts of one text; four zero bytes follow it, so every byte opens a window."""
    out = np.zeros(1 << bits, dtype=np.int64)
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    for lo in range(0, len(data), _CHUNK):
        n = min(_CHUNK, len(data) - lo)
        part = padded[lo : lo + n + 4].astype(np.uint32)
        for salt, (i, j, k) in enumerate(_TRIPLETS):
            x = part[i : i + n] | (part[j : j + n] << np.uint32(8)) | (part[k : k + n] << np.uint32(16))
            x *= np.uint32(0x9E3779B1)
            x ^= np.uint32(0x3C6EF372 * (salt + 1) & 0xFFFFFFFF)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x85EBCA77)
            out += np.bincount((x >> np.uint32(32 - bits)).astype(np.int64), minlength=1 << bits)
    return out


def digest(data: np.ndarray | bytes, conf: Digest = Digest()) -> str:
    """Hex: length class (1 byte), two quartile ratios (1 byte), then a two-bit code a bucket."""
    data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    counts = _counts(data, conf.bits)
    cuts = np.sort(counts)[[len(counts) // 4 - 1, len(counts) // 2 - 1, 3 * len(counts) // 4 - 1]]
    code = (counts[:, None] > cuts[None, :]).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    length = min(255, int(np.ceil(np.log(len(data)) / np.log(1.1)))) if len(data) else 0
    ratios = [int(16 * c // (cuts[2] + 1)) & 15 for c in cuts[:2]]
    return bytes([length, ratios[0] << 4 | ratios[1]]).hex() + packed.tobytes().hex()


def _decoded(prints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), -1)
    code = np.stack([raw[:, 2:] >> s & 3 for s in (0, 2, 4, 6)], axis=2).reshape(len(prints), -1)
    return raw[:, 0].astype(np.int32), raw[:, 1].astype(np.int32), code.astype(np.int32)


def likeness(a: list[str], b: list[str], conf: Digest = Digest()) -> np.ndarray:
    """0 to 1 for pairs of digests: 1 for equal ones, 0 from the bound on."""
    if not a:
        return np.zeros(0)
    (la, ra, ca), (lb, rb, cb) = _decoded(a), _decoded(b)
    length = np.minimum(np.abs(la - lb), 24)
    ratio = np.minimum(np.abs((ra >> 4) - (rb >> 4)), 4) + np.minimum(np.abs((ra & 15) - (rb & 15)), 4)
    apart = _APART[np.abs(ca - cb)].sum(axis=1)
    scale = (1 << conf.bits) / 256
    return np.clip(1 - (apart + (length + ratio) * scale) / (conf.far * (1 << conf.bits)), 0, 1)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(conf: Digest):
    import hashlib

    def flush(rows: list[tuple[int | None, str, str]], last: tuple[str, str]) -> pa.RecordBatch:
        """rows: id, text, digest in order; last: text and digest after them."""
        after = [(t, d) for _, t, d in rows[1:]] + [last]
        texts = [edited(t, u) for (_, t, _), (u, _) in zip(rows, after, strict=True)]
        raw = [x.encode() for x in texts]
        prints, changed = [d for *_, d in rows], [digest(x, conf) for x in raw]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, *_ in rows], pa.int64()),
                pa.array([len(t) for _, t, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                pa.array(prints, pa.string()),
                pa.array(changed, pa.string()),
                pa.array(likeness(prints, changed, conf), pa.float64()),
                pa.array(likeness(prints, [d for _, d in after], conf), pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str, str]] = []
        for batch in batches:
            for i, t, ghost in zip(batch["doc_id"], batch["text"], batch["ghost"], strict=True):
                i, t = i.as_py(), t.as_py() or ""
                own = digest(t.encode(), conf)
                if ghost.as_py():
                    # The first ghost closes the range; others are further rows with its id.
                    if held:
                        yield flush(held, (t, own))
                        held = []
                    continue
                held.append((i, t, own))
                if len(held) > 256:
                    yield flush(held[:-1], held[-1][1:])
                    held = held[-1:]
        assert not held, "a range without a row after it"

    return run


def neighbours(docs: DataFrame, conf: Digest = Digest()) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with the likeness to that and to the next document.

    Documents follow each other by descending doc_id, null ids last, ties by
    text; after the last comes the first.  Null text is empty.  Repeated rows
    are documents of their own, one after the other.  A single document is its
    own next one.  A text of any length is digested whole, a part at a time;
    further columns are not read.  An empty table gives no rows.
    """
    base = shared.own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    placed, cuts = ranges.ringed(base)
    order = [F.col("ghost"), F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    return ranges.dealt(placed, cuts).sortWithinPartitions(*order).mapInArrow(_neighbours(conf), _RESULT)
