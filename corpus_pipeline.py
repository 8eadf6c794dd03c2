"""The corpus pipeline: quality rules, toxicity, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read back as the next one's docs.  All but the last return the
columns of documents.

In every stage: a null text is an empty text, and texts of any length are
worked on whole.  Rows with null or equal ids are rows of their own: filters
judge each row by its text, line dedup takes equal ids in the order of a hash
of id and text, near-dedup keeps one row of each group by (doc_id, null last,
then that hash).  Repeated rows get equal verdicts; near-dedup keeps one.  An
empty table gives an empty table.  Extra columns travel inside one column, so
their names can't clash with an operator's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import linededup, neardup, packing, quality, shared, toxicity
from factloom.llm.queries import tokenizer

#: No stage's verdict is plain SQL: the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _carrying(docs: DataFrame) -> DataFrame:
    """The row as one column, so that no column of documents can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.judge(_carrying(docs), _labels(spark, sf_dir), carry=("row",))
    return judged.filter("kept").select("row.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the cut; fitted on the labels of this stage's own documents."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.score(_carrying(docs), model, carry=("row",)).filter("predicted = 0").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, later repeated passages deleted; n_chars follows the text."""
    out = linededup.dedup_passages(_carrying(docs))

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == "text":
            own = F.col("text")
        elif name == "n_chars":
            own = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(own).cast(docs.schema["n_chars"].dataType)
        return own.alias(name)

    return out.select(*map(column, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, and all rows without words: five-word shingles, similarity 0.8."""
    return neardup.one_of_each(docs, neardup.Join(shingle=5, percent=80))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of at most 4096 tokens."""
    table = packing.pieces(docs, tokenizer("word_bpe_49k.json"))
    out, _ = packing.placed(table.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("toxicity", not_toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("best_fit_packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name)
    return docs
