"""Shared storage for intermediate tables: the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only where none is set (tests, local mode)."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        there = tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", there)
        import shutil

        atexit.register(shutil.rmtree, there, True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/factloom-{name}-{uuid.uuid4().hex}"


#: With it, Spark removes an execution's shuffle files when the execution ends; without, some time after the driver's next garbage collection.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files behind.  For those whose frames nothing reads again."""
    before = spark.conf.get(_CLEANED, "false")
    spark.conf.set(_CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANED, before)


def stored(df: DataFrame, name: str, distinct: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut, and lost executors lose nothing.

    distinct: columns, such as hashes, that a dictionary of values doesn't help.
    """
    spark = df.sparkSession
    to = path(spark, name)
    with releasing(spark):
        df.write.options(compression="zstd", **{f"parquet.enable.dictionary#{c}": "false" for c in distinct}).parquet(to)
    out = spark.read.schema(df.schema).parquet(to)
    out.stored_at = to
    return out


def drop(*frames: DataFrame) -> None:
    """Remove tables made by :func:`stored` that nothing reads any more."""
    for df in frames:
        remove(df.sparkSession, df.stored_at)


def remove(spark: SparkSession, where: str) -> None:
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(where)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def exists(spark: SparkSession, where: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(where)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def read_text(spark: SparkSession, where: str) -> str | None:
    """A small file's text, by whatever file system holds it; None if it isn't there."""
    if not exists(spark, where):
        return None
    there = spark._jvm.org.apache.hadoop.fs.Path(where)
    stream = there.getFileSystem(spark._jsc.hadoopConfiguration()).open(there)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, where: str, text: str) -> None:
    """A small file, seen whole or not at all: written beside its place and renamed over it."""
    Path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    beside, there = Path(f"{where}.{uuid.uuid4().hex}.tmp"), Path(where)
    files = there.getFileSystem(conf)
    stream = files.create(beside)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(there):
        files.delete(there, False)
    if not files.rename(beside, there):
        raise OSError(f"{where} could not be written")
