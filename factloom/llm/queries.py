"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, kernel, linededup, lm, neardup, packing, quality, shared, toxicity, urlfilter, wavelet


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(kernel.crc32_mod("doc_id", 4) != 2))
    out = toxicity.score(docs, model)
    return out.withColumn("held_out", kernel.crc32_mod("doc_id", 4) == 2).select("doc_id", "held_out", "score", "predicted", "n_sentences", "offending")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.when(F.col("quality") == 0, "block").when(F.col("quality") == 1, "allow").alias("label"))
    return urlfilter.judge(_table(spark, sf_dir, "pages"), labels)


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = shared.path(spark, "shards")
    wavelet.write(_table(spark, sf_dir, "documents"), where, tokenizer("word_bpe_49k.json"))
    out = wavelet.read(spark, where)
    return out.select("doc_id", "start", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.similarity_classes(_table(spark, sf_dir, "documents"), neardup.Join(shingle=2, percent=80))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = kernel.crc32_mod("doc_id", 10) == 0
    out = lm.scored(docs, lm.fit(docs.filter(~held)))
    return out.withColumn("held_out", held).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = packing.pieces(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    out, _ = packing.placed(table.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "removed")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encoded(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_toxicity, op2_url_filter, op3_wavelet_tokens, op4_minhash_neardup, op5_lm_score, op6_packing, op7_line_dedup, op8_quality, op9_fingerprint, op10_bpe)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """No operator here is SQL: models, digests, sketches and packings are tested against brute force in tests/llm."""
    import corpus_pipeline

    return {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
