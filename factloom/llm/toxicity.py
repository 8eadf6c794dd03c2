"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is a logistic
function of its hashed words; the document's is their noisy-or with a leak
for label noise.  Only documents carry labels in training; the sentence
scores then locate the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared


@dataclass(frozen=True)
class Bags:
    """buckets: of hashed words; sample: about how many labelled documents are fitted (chosen by a hash of
    their id, so the bound on the driver holds at every size); least_documents: that a bucket must occur in;
    rounds, step, decay: of the fit; rest: the log-odds of a sentence without evidence; cut: of predicted;
    offends: the least probability of a located sentence.
    """

    buckets: int = 1 << 18
    sample: int = 12_000
    least_documents: int = 5
    rounds: int = 120
    step: float = 0.15
    decay: float = 4e-5
    rest: float = -11.0
    cut: float = 0.3
    offends: float = 0.3


_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_ENDS = kernel.byte_table(b".!?\n")


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    leak: float


def _sentences(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """starts, ends and first of each row of the sentences of a block, and the words' buckets with their sentence."""
    starts, ends, first = kernel.spans(~_ENDS[data], offsets)
    words = kernel.Words(data, offsets, lower=True, inside=_WORD[data])
    sentence = np.searchsorted(starts, words.starts, "right") - 1
    return starts, ends, first, (words.hash % np.uint64(buckets)).astype(np.int64), sentence


def _bags(conf: Bags):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch["toxic"].to_pylist()
            rows: list[tuple[int, bytes, bytes]] = []
            for lo, hi, data, offsets in kernel.blocks(batch["text"]):
                _, _, first, bucket, sentence = _sentences(data, offsets, conf.buckets)
                pairs = np.unique(sentence * conf.buckets + bucket)
                sentence, bucket = pairs // conf.buckets, pairs % conf.buckets
                cuts = np.searchsorted(sentence, first)
                for i in range(hi - lo):
                    part = slice(cuts[i], cuts[i + 1])
                    rows.append((toxic[lo + i], bucket[part].astype(np.uint32).tobytes(), (sentence[part] - first[i]).astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["toxic", "bucket", "sentence"])

    return run


def _summed(to: np.ndarray, value: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Sums of value[of] by ``to``, a part at a time, so that no array of all words is made."""
    out = np.zeros(size)
    for lo in range(0, len(to), 1 << 19):
        out += np.bincount(to[lo : lo + (1 << 19)], weights=value[of[lo : lo + (1 << 19)]], minlength=size)
    return out


def fit_bags(toxic: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], conf: Bags = Bags()) -> Model:
    """Weights from documents: bags[i] are the buckets and their sentences of document i; the list is used up."""
    n = len(toxic)
    weight, bias = np.zeros(conf.buckets), conf.rest
    if n == 0 or not toxic.any():
        return Model(weight.astype(np.float32), bias, 1e-3)
    seen, hurt = np.zeros(conf.buckets), np.zeros(conf.buckets)
    for y, (bucket, _) in zip(toxic, bags, strict=True):
        once = np.unique(bucket)
        seen[once] += 1
        hurt[once] += y
    used = seen >= conf.least_documents
    size = sum(int(used[bucket].sum()) for bucket, _ in bags)
    if not size:
        bags.clear()
        return Model(weight.astype(np.float32), bias, float(np.clip(toxic.mean(), 1e-3, 0.5)))
    column, row = np.empty(size, np.int32), np.empty(size, np.int32)
    doc_of, at, done = [], 0, 0
    for i, (bucket, sentence) in enumerate(bags):
        keep = used[bucket]
        bucket, sentence = bucket[keep], sentence[keep]
        bags[i] = None
        if len(sentence):
            _, dense = np.unique(sentence, return_inverse=True)
            column[done : done + len(bucket)], row[done : done + len(bucket)] = bucket, dense + at
            done += len(bucket)
            doc_of.append(np.full(dense[-1] + 1, i, np.int32))
            at += int(dense[-1]) + 1
    bags.clear()
    doc_of = np.concatenate(doc_of)
    names = np.flatnonzero(np.bincount(column, minlength=conf.buckets))
    place = np.zeros(conf.buckets, np.int32)
    place[names] = np.arange(len(names))
    column = place[column]
    y = toxic.astype(float)
    p1, p0 = (hurt[names] + 0.1) / (y.sum() + 1), (seen[names] - hurt[names] + 0.1) / (n - y.sum() + 1)
    sure = (hurt[names] >= 5) & (p1 > 3 * p0)
    w = np.where(sure, np.log(p1 / p0) * 2, 0.0)
    b, leak = conf.rest, 0.02
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, conf.rounds + 1):
        z = _summed(row, w, column, at) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p = np.minimum(p, 1 - 1e-6)
        none = np.exp(np.bincount(doc_of, weights=np.log1p(-p), minlength=n)) * (1 - leak)
        whole = np.maximum(1 - none, 1e-9)
        up = np.where(y == 1, -none / whole, 1.0)
        g = _summed(column, p * up[doc_of], row, len(w)) / n + conf.decay * np.sign(w) + conf.decay * 0.1 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= conf.step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-5)
        # The leak is what the sentences leave unexplained among documents labelled toxic.
        leak = float(np.clip(np.mean(y * leak / whole), 1e-4, 0.2))
    weight[names] = w
    return Model(weight.astype(np.float32), b, leak)


def fit(docs: DataFrame, labels: DataFrame, conf: Bags = Bags()) -> Model:
    """Fit on a bounded sample of the labelled documents (labels: doc_id, toxic).

    Null labels and null ids are ignored; of labels that disagree on an id, 1
    counts, and every row with that id has it.  Rows are sorted by their
    content before the fit, so their order doesn't matter.  No labels, or none
    that is 1: every sentence is clean.  Extra columns are not read.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    count = known.count()
    share = 1 << 20 if count <= conf.sample else conf.sample * (1 << 20) // count
    some = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    rows = shared.own_columns(docs, "doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic").mapInArrow(kernel.tidy(_bags(conf)), "toxic int, bucket binary, sentence binary").toArrow()
    held = sorted(zip(rows["toxic"].to_pylist(), rows["bucket"].to_pylist(), rows["sentence"].to_pylist(), strict=True))
    del rows
    toxic = np.array([r[0] for r in held], dtype=np.int64)
    bags = [(np.frombuffer(r[1], np.uint32), np.frombuffer(r[2], np.uint32)) for r in held]
    del held
    return fit_bags(toxic, bags, conf)


_RESULT = "score double, predicted int, n_sentences long, offending array<struct<start:long,end:long,p:double>>"


def _apply(model: Model, conf: Bags, names: list[str]):
    located = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.weight.astype(np.float64)
        for batch in batches:
            score, many = [np.zeros(0)], [np.zeros(0, np.int64)]
            starts_of, ends_of, p_of, count_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in kernel.blocks(batch["text"]):
                starts, ends, first, bucket, sentence = _sentences(data, offsets, conf.buckets)
                n = len(starts)
                # A word counts once in a sentence.
                key = np.sort(sentence * conf.buckets + bucket)
                key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
                z = np.bincount(key // conf.buckets, weights=weight[key % conf.buckets], minlength=n) + model.bias
                p = np.minimum(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 - 1e-6)
                left = np.concatenate([[0.0], np.cumsum(np.log1p(-p))])
                score.append(1 - (1 - model.leak) * np.exp(left[first[1:]] - left[first[:-1]]))
                many.append(np.diff(first))
                hot = p >= conf.offends
                base = np.repeat(offsets[:-1], np.diff(first))
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                starts_of.append((chars[starts] - chars[base])[hot])
                ends_of.append((chars[ends] - chars[base])[hot])
                p_of.append(p[hot])
                count_of.append(np.diff(np.concatenate([[0], np.cumsum(hot)])[first]))
            total = np.clip(np.concatenate(score), 0, 1)
            values = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in (starts_of, ends_of, p_of)], fields=list(located.value_type))
            spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.concatenate(count_of))]).astype(np.int32)), values, type=located)
            yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), pa.array(total), pa.array((total >= conf.cut).astype(np.int32)), pa.array(np.concatenate(many)), spans], names=[*names, "score", "predicted", "n_sentences", "offending"])

    return run


def score(docs: DataFrame, model: Model, conf: Bags = Bags(), carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of every row with score, predicted, n_sentences and offending.

    offending: the code point ranges of the sentences whose probability is at
    least ``conf.offends``.  Sentences end at . ! ? or a line's end.  Null or
    empty text has no sentence and scores the leak.  Ids, languages, sources
    and labels are no inputs.  Repeated rows get equal results, rows with null or
    equal ids are scored by their text, texts of any length whole; an empty
    table gives no rows.  ``carry`` may name any columns but the results' own.
    """
    fields = [f"`{x}` {docs.schema[x].dataType.simpleString()}, " for x in carry]
    return docs.select("text", *(x for x in carry if x != "text")).mapInArrow(kernel.tidy(_apply(model, conf, list(carry))), "".join(fields) + _RESULT)
