"""The hash-chained audit log: sequential writing, parallel verification."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import SEPARATOR, iso_instant, joined_hash
from ..schema import CHAIN_AUDIT
from ..storage import exists
from .ranks import previous

FIELDS = ("run_id", "system_id", "accession_number", "stage", "extraction_status", "detail", "content_hash")


def row_hash(previous: Column, fields: tuple[str, ...] = FIELDS, created: str | None = "created_at") -> Column:
    """SHA-256 over the fields, the time and the previous hash; null and "" hash alike."""
    stamp = [F.concat(iso_instant(F.col(created)), F.lit("+00:00"))] if created else []
    return joined_hash(*[F.col(f) for f in fields], *stamp, previous)


def chained(rows: list[dict], tail: str | None = None, first_id: int = 1, fields: tuple[str, ...] = FIELDS) -> list[dict]:
    """One batch of rows linked to the chain's tail, by sorted accession: each hash needs the one before, so one fold.

    A batch is a run's outcomes, not the log; for scale a log has one chain for each run.
    """
    out = []
    for n, row in enumerate(sorted(rows, key=lambda r: r.get("accession_number") or "")):
        created = row["created_at"]
        stamp = created.strftime("%Y-%m-%dT%H:%M:%S") + (f".{created.microsecond:06d}" if created.microsecond else "") + "+00:00"
        text = SEPARATOR.join([*(str(row[f]) if row.get(f) is not None else "" for f in fields), stamp, tail or ""])
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append(row | {"id": first_id + n, "prev_row_hash": tail, "row_hash": digest})
        tail = digest
    return out


def fold(rows: DataFrame, chain: str, order: str, payload: Column) -> DataFrame:
    """(chain, order, row_hash): an ordered fold of sha256(payload \\x1f previous) along each chain.

    Each hash needs the one before, so a chain is one task's work; it streams
    through it in order and nothing but the last hash is held.
    """
    spread = rows.select(chain, order, payload.alias("_payload")).repartition(F.col(chain)).sortWithinPartitions(chain, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = object(), ""
        for batch in batches:
            out = []
            for of, text in zip(batch[chain].to_pylist(), batch["_payload"].to_pylist(), strict=True):
                last = hashlib.sha256(f"{text or ''}{SEPARATOR}{last if of == now else ''}".encode()).hexdigest()
                now = of
                out.append(last)
            yield pa.RecordBatch.from_arrays([batch[chain], batch[order], pa.array(out, pa.string())], names=[chain, order, "row_hash"])

    kind = lambda c: rows.schema[c].dataType.simpleString()
    return spread.mapInArrow(run, f"`{chain}` {kind(chain)}, `{order}` {kind(order)}, row_hash string")


def breaks(log: DataFrame, expected: Column, order: str = "id", chain: str | None = None) -> DataFrame:
    """(order, reason) of every row whose link or content does not hold; a broken link is named first.

    Rows meet their predecessor by sorted ranges, hashing is parallel.
    """
    linked = previous(log, order, "row_hash", "_before", chain).withColumn("_want", expected)
    reason = F.when(~F.col("prev_row_hash").eqNullSafe(F.col("_before")), "link").when(~F.col("row_hash").eqNullSafe(F.col("_want")), "content")
    return linked.select(order, reason.alias("reason")).filter("reason is not null")


def verify(log: DataFrame, expected: Column, order: str = "id", chain: str | None = None) -> DataFrame:
    """(valid, total_rows, broken_at, broken_reason, checked): a deleted tail shows only in total_rows.

    checked: rows up to the first break, which a reader going in order would have looked at.
    """
    broken = breaks(log, expected, order, chain).agg(F.min(F.struct(order, "reason")).alias("b"))
    upto = log.select(order).crossJoin(F.broadcast(broken)).agg(F.count("*").alias("total_rows"), F.count_if(F.col("b").isNull() | (F.col(order) <= F.col(f"b.{order}"))).alias("checked"))
    return upto.crossJoin(broken).select(F.col("b").isNull().alias("valid"), "total_rows", F.col(f"b.{order}").alias("broken_at"), F.col("b.reason").alias("broken_reason"), "checked")


def tail(log: DataFrame, order: str = "id") -> tuple[int, str | None]:
    """(id, row_hash) of the last row; (0, None) of an empty log."""
    last = log.agg(F.max(F.struct(order, "row_hash")).alias("t")).first()["t"]
    return (last[0], last[1]) if last else (0, None)


def system_id(environment: Mapping[str, str] | None = None) -> str:
    """Who writes: PIPELINE_SYSTEM_ID, else the default name."""
    return (os.environ if environment is None else environment).get("PIPELINE_SYSTEM_ID") or "factloom"


class Log:
    """An append-only chained log as a table of Parquet files.  It has no way to change or delete a row; :func:`verify` shows what others did.

    One writer at a time: a row needs the hash of the row before.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], CHAIN_AUDIT)
        return self.spark.read.schema(CHAIN_AUDIT).parquet(self.path)

    def append(self, rows: list[dict]) -> list[dict]:
        """A batch of outcomes in the order of their accessions, linked to the log's tail; gives the rows that were written."""
        last, digest = tail(self.read())
        made = chained(rows, digest, last + 1)
        names = [c.split()[0] for c in CHAIN_AUDIT.split(", ")]
        if made:
            self.spark.createDataFrame([tuple(r.get(c) for c in names) for r in made], CHAIN_AUDIT).coalesce(1).write.mode("append").parquet(self.path)
        return made

    def verify(self) -> DataFrame:
        return verify(self.read(), row_hash(F.coalesce("prev_row_hash", F.lit(""))))
