"""Quality rules: a hashed n-gram log-likelihood ratio of two multinomials.

One multinomial is counted over a trusted target (documents labelled good),
one over the raw corpus.  A document's score is the mean over its 1- and
2-grams of ln(p_target / p_raw); it is kept if the score is at least a
threshold that labelled documents fix.  Nothing is drawn at random.
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
class Ratio:
    """buckets: of hashed n-grams; prior: raw-shaped counts added to each bucket of the target, so that rare buckets say little.

    spare: the share of trusted documents that may fall below the threshold; grain: width of the
    steps in which scores are counted for it; least_words, repeat_percent: of the base rules.
    """

    buckets: int = 16384
    prior: float = 20.0
    spare: float = 0.0005
    grain: float = 0.01
    least_words: int = 50
    repeat_percent: int = 50


#: Labelled ids are broadcast up to this many rows (9 bytes each).
BROADCAST_ROWS = 1_000_000

_SYMBOLS = kernel.byte_table(b"#*$%&|<>")
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True


def grams(words: kernel.Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs of a block, and the row of each."""
    h, row = words.hash, words.row
    pair = np.flatnonzero(row[1:] == row[:-1]) if len(h) else np.zeros(0, np.int64)
    two = kernel.mix(h[pair] * np.uint64(0x2545F4914F6CDD1D) + h[pair + 1])
    both = np.concatenate([h, two])
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[pair]])


def _count(conf: Ratio):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((3, conf.buckets), np.int64)
        for batch in batches:
            fold = batch["fold"].fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in kernel.blocks(batch["text"]):
                bucket, row = grams(kernel.Words(data, offsets), conf.buckets)
                of = fold[lo:hi][row]
                for k in range(3):
                    count[k] += np.bincount(bucket[of == k], minlength=conf.buckets)
        at = np.flatnonzero(count.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(count[k][at]) for k in range(3))], names=["bucket", "n0", "n1", "n2"])

    return run


def weights(docs: DataFrame, conf: Ratio = Ratio()) -> np.ndarray:
    """ln(p_target / p_raw) of each bucket, counted over every row of ``docs`` (text, fold).

    fold: 0 for the raw corpus alone, 1 and 2 for trusted documents.  Three
    rows: of the whole target, and of folds 1 and 2 alone.  They hold
    ``conf.buckets`` numbers, whatever the input's size.  Without a trusted
    row, or without rows, all weights are 0.
    """
    counted = docs.select("text", "fold").mapInArrow(kernel.tidy(_count(conf)), "bucket long, n0 long, n1 long, n2 long")
    count = np.zeros((3, conf.buckets))
    for r in counted.groupBy("bucket").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(3)]).collect():
        count[:, r["bucket"]] = r["n0"], r["n1"], r["n2"]
    raw = count.sum(axis=0)

    def ratio(good: np.ndarray) -> np.ndarray:
        expected = raw * (good.sum() / max(raw.sum(), 1))
        return np.log((good + conf.prior) / (expected + conf.prior)) if good.sum() else np.zeros(conf.buckets)

    return np.stack([ratio(count[1] + count[2]), ratio(count[1]), ratio(count[2])])


def base_figures(data: np.ndarray, offsets: np.ndarray, words: kernel.Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row of a block."""
    n = len(offsets) - 1
    per_row = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[offsets])
    chars = per_row(~(kernel.SPACE[data] | _CONTINUES[data]))
    symbols = per_row(_SYMBOLS[data])

    starts, ends, first = kernel.spans(data != 10, offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    worded = np.searchsorted(words.starts, starts, "left") < np.searchsorted(words.starts, ends, "left")
    row, line = row[worded], kernel.hash_spans(data, starts, ends)[worded]
    key = kernel.mix(line + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, once = np.unique(key, return_index=True)
    dup = np.bincount(row, minlength=n) - np.bincount(row[once], minlength=n)

    h, of = words.hash, words.row
    repeat = np.zeros(len(h), bool)
    if len(h) > 2:
        at = np.flatnonzero(of[2:] == of[:-2])
        window = kernel.mix(kernel.mix(h[at] * np.uint64(0x2545F4914F6CDD1D) + h[at + 1]) * np.uint64(0xA24BAED4963EE407) + h[at + 2])
        window = kernel.mix(window + of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(window)
        same = window[order][1:] == window[order][:-1]
        hit = np.zeros(len(at), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        for j in range(3):
            repeat[at[hit] + j] = True
    return {
        "n_words": words.counts,
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dup,
        "n_repeat_words": np.bincount(of[repeat], minlength=n),
    }


_FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def _score(conf: Ratio, weight: np.ndarray, names: list[str]):
    """A row of the trusted folds 1 and 2, where ``fold`` is carried, takes the other fold's weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            fold = batch["fold"].to_numpy() if "fold" in names else None
            for lo, hi, data, offsets in kernel.blocks(batch["text"]):
                words = kernel.Words(data, offsets)
                bucket, row = grams(words, conf.buckets)
                n = len(offsets) - 1
                of = weight[0][bucket] if fold is None else weight[(3 - fold[lo:hi])[row], bucket]
                total, many = np.bincount(row, weights=of, minlength=n), np.bincount(row, minlength=n)
                parts.append([*(x.astype(np.int64) for x in base_figures(data, offsets, words).values()), total / np.maximum(many, 1)])
            if parts:
                yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), *(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))], names=[*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    return run


def scored(docs: DataFrame, weight: np.ndarray, carry: list[str], conf: Ratio = Ratio()) -> DataFrame:
    """The carried columns with the base figures and the ratio score of every whole text."""
    fields = [f"`{x}` {docs.schema[x].dataType.simpleString()}, " for x in carry]
    return docs.select("text", *(x for x in carry if x != "text")).mapInArrow(kernel.tidy(_score(conf, weight, carry)), "".join(fields) + _FIGURES)


def threshold(trusted_scores: DataFrame, conf: Ratio = Ratio()) -> float:
    """The score below which at most ``conf.spare`` of the trusted rows lie: counted over all of them in fixed steps."""
    step = F.floor(F.col("score") / F.lit(conf.grain))
    steps = sorted((r["step"], r["n"]) for r in trusted_scores.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect())
    total, below = sum(n for _, n in steps), 0
    for at, n in steps:
        if below + n > conf.spare * total:
            return at * conf.grain
        below += n
    return -np.inf


def _failed(conf: Ratio):
    return (F.col("n_words") < conf.least_words) | (100 * F.col("n_repeat_words") > conf.repeat_percent * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, conf: Ratio = Ratio(), carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of every row of ``docs`` with base figures, score, base_failed and kept.

    The trusted target is what ``labels`` (doc_id, quality) marks with quality 1
    and not 0; a document without a label belongs to the raw corpus alone.  Null
    text: no words.  A row is kept unless it fails the base rules (fewer than
    ``least_words`` words, or over ``repeat_percent`` % of them in repeated
    three-word windows) or scores below the threshold.  Null ids match no
    label; of labels that disagree on an id the lower one counts, and every row
    with that id has it.  Repeated rows get equal results, texts of any length
    are counted whole; ``carry`` may name any columns but the results' own.  An
    empty table gives no rows.
    """
    good = labels.select(F.col("doc_id").alias("_id"), "quality").groupBy("_id").agg((F.min("quality") == 1).alias("trusted"))
    base = shared.own_columns(docs, "doc_id", "text")
    fold = F.when(F.col("trusted"), 1 + F.pmod(F.xxhash64("_id"), F.lit(2)).cast("int")).otherwise(F.lit(0))
    # Ids of trusted documents are broadcast once counted; more of them than that meet the texts in a shuffle.
    good = good.filter("trusted")
    good = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good
    marked = base.join(good, F.col("doc_id") == F.col("_id"), "left").select("text", fold.alias("fold"))
    weight = weights(marked, conf)
    # Trusted documents fix the threshold by what the other half of them says of them.
    known = scored(marked.filter("fold > 0"), weight, ["fold"], conf).filter(~_failed(conf))
    least = threshold(known, conf)
    out = scored(docs, weight, list(carry), conf)
    failed = _failed(conf)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= F.lit(float(least))))
