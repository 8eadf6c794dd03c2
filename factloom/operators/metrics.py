"""Run metrics from the stage audit."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import exists
from .merge import keep_newest


def stage_counts(audit: DataFrame, run: str, stage: str, records: str, order: str) -> DataFrame:
    """(run, stage, records): of the last row of each stage, whatever its status."""
    return audit.groupBy(run, stage).agg(F.max_by(records, order).alias("records"))


def success_rate(audit: DataFrame, run: str, status: str, good: str) -> DataFrame:
    """(run, n, failures, rate): rate to three places.  A run without rows has none here; see :func:`run_rates`."""
    s = audit.groupBy(run).agg(F.count("*").alias("n"), F.count_if(F.col(status) != good).alias("failures"))
    return s.withColumn("rate", F.round(((F.col("n") - F.col("failures")).cast("decimal(18,0)") / F.col("n").cast("decimal(18,0)")).cast("decimal(20,10)"), 3).cast("double"))


def stage_durations(audit: DataFrame, run: str, stage: str, status: str, at: str, order: str, started: str, completed: str) -> DataFrame:
    """(run, stage, seconds): last completion less last start, not negative, to three places."""
    mark = lambda s: F.max_by(F.when(F.col(status) == s, F.col(at)), F.when(F.col(status) == s, F.col(order)))
    s = audit.filter(F.col(status).isin(started, completed)).groupBy(run, stage).agg(mark(started).alias("s"), mark(completed).alias("e"))
    micros = F.unix_micros(F.col("e").cast("timestamp")) - F.unix_micros(F.col("s").cast("timestamp"))
    return s.filter("s is not null and e is not null").select(run, stage, F.round((F.greatest(micros, F.lit(0)) / 1e6), 3).alias("seconds"))


# The stages whose records a run reports, and the names that durations go by.
STAGES = ("ingest", "parse", "validate", "load")
DURATIONS = {"ingest": "fetch_new_filings", "parse": "parse_xbrl_facts", "validate": "validate_quality_gates", "score": "score_anomalies", "load": "load_to_warehouse", "audit_trail": "update_audit_trail"}


def run_counts(audit: DataFrame, run_id: str) -> DataFrame:
    """One row: the records of each reported stage, by its last row; 0 without one.  What was downloaded is what was ingested."""
    own = audit.filter(F.col("run_id") == run_id)
    last = lambda s: F.coalesce(F.max_by(F.when(F.col("stage") == s, F.coalesce("records_processed", F.lit(0))), F.when(F.col("stage") == s, F.col("id"))), F.lit(0))
    one = own.agg(*[last(s).alias(s) for s in STAGES])
    return one.select(F.col("ingest").alias("filings_ingested"), F.col("ingest").alias("filings_downloaded"), F.col("parse").alias("filings_parsed"), F.col("validate").alias("filings_validated"), F.col("load").alias("filings_loaded"))


def run_rates(outcomes: DataFrame, run_id: str) -> DataFrame:
    """One row: the share of parse outcomes that succeeded, to three places, and how many didn't; 1 and 0 without outcomes."""
    own = outcomes.filter((F.col("run_id") == run_id) & (F.col("stage") == "parse"))
    s = own.agg(F.count("*").alias("n"), F.count_if(~F.col("extraction_status").eqNullSafe("success")).alias("bad"))
    good = F.coalesce(F.try_divide((F.col("n") - F.col("bad")).cast("double"), F.col("n")), F.lit(1.0))
    return s.select(F.round(good, 3).alias("parsing_success_rate"), F.col("bad").alias("parsing_failure_count"), F.lit(1.0).alias("validation_success_rate"))


def newest(runs: DataFrame, run_id: str) -> DataFrame:
    """The model run of a pipeline run that was made last, as one row or none."""
    return keep_newest(runs.filter(F.col("run_id") == run_id), ["run_id"], "created_at")


def anomaly_rate(runs: DataFrame, run_id: str) -> DataFrame:
    """One row: what the newest model run flagged, and its share of the scored filings, to three places; 0 without a run."""
    s = newest(runs, run_id).agg(F.max("anomalies_flagged").alias("f"), F.max("filings_scored").alias("n"))
    share = F.coalesce(F.try_divide(F.col("f").cast("double"), F.col("n")), F.lit(0.0))
    return s.select(F.coalesce("f", F.lit(0)).cast("int").alias("anomalies_flagged"), F.round(share, 3).alias("anomaly_rate"))


def run_durations(audit: DataFrame, run_id: str) -> DataFrame:
    """One row with durations_seconds, a map: last completion less last start of each stage that has both, and total, from the first of these starts to the last end."""
    own = audit.filter(F.col("run_id") == run_id)
    at = lambda s: F.max_by(F.when(F.col("status") == s, F.col("created_at")), F.when(F.col("status") == s, F.struct("created_at", "id")))
    per = own.groupBy("stage").agg(at("started").alias("s"), at("completed").alias("e"))
    seconds = lambda a, b: F.round(F.greatest((F.unix_micros(F.col(b).cast("timestamp")) - F.unix_micros(F.col(a).cast("timestamp"))) / 1e6, F.lit(0.0)), 3)
    both = F.col("s").isNotNull() & F.col("e").isNotNull()
    names = F.create_map(*[F.lit(x) for kv in DURATIONS.items() for x in kv])
    entry = F.when(both & names[F.col("stage")].isNotNull(), F.struct(names[F.col("stage")].alias("k"), seconds("s", "e").alias("v")))
    one = per.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("m"), F.min("s").alias("s"), F.max("e").alias("e"))
    total = F.coalesce(seconds("s", "e"), F.lit(0.0))
    return one.select(F.map_concat("m", F.create_map(F.lit("total"), total)).alias("durations_seconds"))


def run_record(audit: DataFrame, outcomes: DataFrame, runs: DataFrame, run_id: str, day: date) -> DataFrame:
    """The whole record of a run as one row: one-row frames side by side."""
    head = audit.sparkSession.range(1).select(F.lit(run_id).alias("run_id"), F.lit(day.isoformat()).alias("run_date"))
    for part in (run_counts(audit, run_id), run_rates(outcomes, run_id), anomaly_rate(runs, run_id), run_durations(audit, run_id)):
        head = head.crossJoin(part)
    return head


RECORD = "run_id string, run_date string, filings_ingested int, filings_downloaded int, filings_parsed int, filings_validated int, filings_loaded int, parsing_success_rate double, parsing_failure_count bigint, validation_success_rate double, anomalies_flagged int, anomaly_rate double, durations_seconds map<string,double>"


def append_record(record: DataFrame, path: str) -> None:
    """Add a run's record to a folder of JSON lines: whoever reads meanwhile sees whole records only."""
    record.coalesce(1).write.mode("append").json(path)


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records so far; lines that aren't records are left out, a folder that isn't there has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("mode", "DROPMALFORMED").json(path).filter("run_id is not null")


def document(spark: SparkSession, path: str, now: datetime) -> str:
    """The records as one JSON document, in the order of their days and runs."""
    rows = [json.loads(r[0]) for r in records(spark, path).orderBy("run_date", "run_id").select(F.to_json(F.struct("*"))).collect()]
    return json.dumps({"generated_at": now.isoformat(), "runs": rows}, indent=2)
