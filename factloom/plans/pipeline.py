"""A run of ordered stages: Parquet between them, audit rows about them, and a new attempt that goes on where the last one ended."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..schema import STAGE_AUDIT
from ..storage import exists


class StageFailed(RuntimeError):
    """Raised by a stage that another attempt can't help."""


class Skip(Exception):  # noqa: N818  not an error: there is nothing to do
    """Raised by a stage that has nothing to do; the stages after it don't run."""


@dataclass
class Run:
    """Runs stages in order; each gets (spark, frame of the stage before) and returns a frame.

    ``work`` holds each stage's output.  A stage whose output is there, whole,
    from an earlier execution of the same run is not run again.  Stages in
    ``optional`` may fail without ending the run: the next one gets what the
    one before them gave.  ``log`` is where audit rows are appended, if set.
    """

    spark: SparkSession
    run_id: str
    work: str
    stages: list[tuple[str, Callable[[SparkSession, DataFrame | None], DataFrame]]]
    optional: frozenset[str] = frozenset()
    alert: Callable[[str, str], None] = lambda stage, why: None
    retries: int = 2
    pause: float = 0.0
    sleep: Callable[[float], None] = time.sleep
    log: str | None = None
    audit: list[dict] = field(default_factory=list)

    def _mark(self, stage: str, status: str, records: int | None = None, why: str | None = None) -> None:
        row = {"run_id": self.run_id, "stage": stage, "status": status, "records_processed": records, "error_message": why, "created_at": datetime.now(timezone.utc)}
        self.audit.append(row)
        if self.log:
            at = row["created_at"]
            named = {"id": int(at.timestamp() * 1e6)} | row | {"created_at": at.replace(tzinfo=None)}
            names = [c.split()[0] for c in STAGE_AUDIT.split(", ")]
            self.spark.createDataFrame([tuple(named[c] for c in names)], STAGE_AUDIT).coalesce(1).write.mode("append").parquet(self.log)

    def _done(self, to: str) -> bool:
        return exists(self.spark, f"{to}/_SUCCESS")

    def _made(self, stage: Callable, frame: DataFrame | None, to: str) -> tuple[DataFrame, int]:
        """A stage's stored output and its rows, counted while they are written."""
        from pyspark.sql import Observation
        from pyspark.sql import functions as F

        seen, out = Observation(), stage(self.spark, frame)
        out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(to)
        return self.spark.read.schema(out.schema).parquet(to), seen.get["rows"]

    def execute(self) -> DataFrame | None:
        frame = None
        for name, stage in self.stages:
            to = f"{self.work}/{self.run_id}/{name}"
            if self._done(to):
                frame = self.spark.read.parquet(to)
                continue
            self._mark(name, "started")
            for attempt in range(self.retries + 1):
                try:
                    made, rows = self._made(stage, frame, to)
                    frame = made
                    self._mark(name, "completed", rows)
                    break
                except Skip:
                    self._mark(name, "skipped")
                    return None
                except Exception as e:
                    if attempt < self.retries and not isinstance(e, StageFailed):
                        self.sleep(self.pause)
                        continue
                    self._mark(name, "failed", why=str(e)[:500])
                    if name in self.optional:
                        break
                    self.alert(name, str(e))
                    raise
        return frame
