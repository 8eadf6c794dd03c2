"""Incremental ingestion: file streams merged into snapshots, replay-safe."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import upsert
from ..storage import read_text, write_text


class Snapshot:
    """A Parquet table as numbered snapshots with a pointer that is swapped whole.  One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _pointer(self) -> str:
        return f"{self.root}/CURRENT"

    def read(self) -> DataFrame:
        name = read_text(self.spark, self._pointer())
        if name is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{name}")

    def replace(self, rows: DataFrame) -> None:
        name = f"snapshot-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{name}")
        write_text(self.spark, self._pointer(), name)

    def merge(self, new: DataFrame, keys: list[str], order: list[Column]) -> None:
        self.replace(upsert(self.read(), new, keys, order))


def ingest(spark: SparkSession, source: str, schema: str, target: Snapshot, keys: list[str], order: list[Column], checkpoint: str, files_a_batch: int = 1000) -> None:
    """Take what is new in a folder of Parquet files and end: each file once, a replayed batch changes nothing, a later correction overwrites."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    query = stream.writeStream.foreachBatch(lambda df, _: target.merge(df, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def deduplicated(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """First rows of each key within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def high_water(done: DataFrame, company: str, day: str) -> DataFrame:
    """The last processed day of each company."""
    return done.groupBy(company).agg(F.max(day).alias("high_water"))
