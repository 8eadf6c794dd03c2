"""The batch: fetch, download, parse, validate, score, load; backfill with a checkpoint; training.

Every step is a frame to a frame.  What may fail for one filing ends in a
status column of its row, so a bad filing never ends the batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alerts, audit, detector, features, merge, metrics, quality, registry, rules, runs
from ..schema import FACTS, FILINGS, MODEL_RUNS, PREFIX, REQUIRED, SEED
from ..sources import ixbrl, payloads, warehouse
from ..storage import read_text, write_text
from .pipeline import Run, Skip, StageFailed

FORMS = {"10-K": ("10-K",), "10-Q": ("10-Q",), "both": ("10-K", "10-Q")}
#: Minutes between attempts of a stage.
PAUSE_MINUTES = 5


def forms(choice: str) -> list[str]:
    """The forms that a choice names."""
    return list(FORMS.get(choice, (choice,)))


def document_url(cik: str, accession: str, base: str) -> str:
    """Where a filing's documents are: its number stands there without dashes."""
    return f"{base.rstrip('/')}/{cik}/{accession.replace('-', '')}/"


def downloaded(filings: DataFrame, fetch: Callable[[str], str], base: str) -> DataFrame:
    """``filings`` with raw_html, status and detail: success, or failed with the reason.

    One task asks the service, as its limit holds for all of us together;
    ``fetch`` goes there with the task.
    """
    columns = [c for c in filings.columns if c not in ("raw_html", "status", "detail")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, status, detail = [], [], []
            for cik, accession in zip(batch["cik"].to_pylist(), batch["accession_number"].to_pylist(), strict=True):
                try:
                    got, how, why = fetch(document_url(cik, accession, base)), "success", None
                except Exception as e:  # noqa: BLE001  one filing must not end the batch
                    got, how, why = None, "failed", str(e)[:500]
                body.append(got)
                status.append(how)
                detail.append(why)
            added = [pa.array(x, pa.string()) for x in (body, status, detail)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), *added], names=[*columns, "raw_html", "status", "detail"])

    kept = filings.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.coalesce(1).mapInArrow(run, f"{schema}, raw_html string, status string, detail string")


def outcomes(rows: DataFrame, stage: str, run_id: str, system: str | None = None) -> DataFrame:
    """One audit outcome for each accession of (accession_number, status, detail, raw_html if there): the worst status counts."""
    content = F.sha2("raw_html", 256) if "raw_html" in rows.columns else F.lit(None).cast("string")
    rank = F.when(F.col("status") == "failed", 0).when(F.col("status") == "empty", 1).otherwise(2)
    worst = rows.filter("accession_number is not null").groupBy("accession_number").agg(F.min_by(F.struct("status", "detail", content.alias("content_hash")), F.struct(rank, F.coalesce("detail", F.lit("")))).alias("o"))
    return worst.select(F.lit(run_id).alias("run_id"), F.lit(system or audit.system_id()).alias("system_id"), "accession_number", F.lit(stage).alias("stage"), F.col("o.status").alias("extraction_status"), F.col("o.detail").alias("detail"), F.col("o.content_hash").alias("content_hash"))


def load_outcomes(facts: DataFrame, run_id: str, status: str = "success", detail: str | None = None) -> DataFrame:
    """One outcome of the load for each accession: all or nothing, so one status holds for all."""
    return outcomes(facts.select("accession_number").distinct().withColumns({"status": F.lit(status), "detail": F.lit(detail).cast("string")}), "load", run_id)


def recorded(log: audit.Log, rows: DataFrame, now: datetime) -> int:
    """Append a run's outcomes to the chained log, in the order of accessions; those that are there already aren't added again.

    A run's outcomes are few: one a filing.
    """
    new = rows.join(log.read().select("run_id", "stage", "accession_number"), ["run_id", "stage", "accession_number"], "left_anti")
    return len(log.append([r.asDict() | {"created_at": now} for r in new.collect()]))


def _ready(documents: DataFrame, at: datetime) -> DataFrame:
    """Downloaded filings with what a landing row has besides."""
    more = {"file_size_bytes": F.length("raw_html").cast("int"), "ingested_at": F.lit(at.replace(tzinfo=None))}
    return documents.withColumns(more | {c: F.col(c).cast("date") for c in ("filing_date", "period_of_report")})


def landed(existing: DataFrame, new: DataFrame, run_id: str) -> DataFrame:
    """Landing rows: the first one of an accession stays."""
    made = new.select(*[F.col(c) if c in new.columns else F.lit(None).alias(c) for c in existing.columns])
    return merge.insert_if_absent(existing, made.withColumn("pipeline_run_id", F.lit(run_id)), ["accession_number"])


def loaded(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Fact rows: a fact's later value replaces the earlier one."""
    keys = ["accession_number", "fact_name", "period_start", "period_end", "segment"]
    made = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in existing.schema])
    return merge.upsert(existing, made, keys, [F.col("ord")])


# Scoring.


def scored(facts: DataFrame, filings: DataFrame, model: detector.Detector, baseline: DataFrame | None) -> tuple[DataFrame, dict | None]:
    """(score rows, drift report against the model's own baseline; None without one)."""
    matrix = features.build(facts, filings)
    drift = None
    if baseline is not None:
        drift = detector.drift_report(quality.feature_drift(baseline, matrix, list(model.features)))
    return model.score(matrix), drift


def model_run(rows: DataFrame, run_id: str, meta: dict, model: detector.Detector, drift: dict | None, now: datetime) -> DataFrame:
    """The row about a scoring: what was scored, what was flagged, and whether the scores can be trusted."""
    counts = detector.flagged(rows).first()
    report = json.dumps(drift, sort_keys=True, default=str) if drift else None
    row = (int(now.timestamp() * 1e6), run_id, meta["version"], meta["sha256"], meta.get("git_sha"), counts["scored"], counts["flagged"], model.threshold, report, drift["level"] if drift else None, now.replace(tzinfo=None))
    return rows.sparkSession.createDataFrame([row], MODEL_RUNS)


def score_stage(spark: SparkSession, facts: DataFrame, filings: DataFrame, models: registry.Registry, run_id: str, now: datetime) -> tuple[DataFrame | None, DataFrame | None, dict]:
    """(score rows, model-run row, summary).  Without a model that verifies nothing is scored and the summary says why: scores are an aid, not a gate."""
    version = models.production()
    try:
        if version is None:
            raise ValueError("no model is in production")
        model = detector.Detector.from_json(models.load(version))
    except (OSError, ValueError) as e:
        return None, None, {"scored": 0, "flagged": 0, "reason": str(e)}
    rows, drift = scored(facts, filings, model, warehouse.baseline(spark, models.folder(version)))
    rows = rows.persist()
    run = model_run(rows, run_id, models.metadata(version), model, drift, now)
    one = run.first()
    return rows, run, {"scored": one["filings_scored"], "flagged": one["anomalies_flagged"], "model_version": version, "drift_level": one["drift_level"], "reason": None}


# The run.


@dataclass
class Tables:
    """Where a run's tables are: snapshots of landing and facts, the chained log, stage audit, scores, model runs, metrics."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _read(spark: SparkSession, where: str, schema: str) -> DataFrame:
    from ..storage import exists

    return spark.read.schema(schema).parquet(where) if exists(spark, where) else spark.createDataFrame([], schema)


def stages(new_filings: Callable[[SparkSession], DataFrame], fetch: Callable[[str], str], base: str, tables: Tables, run_id: str, work: str, models: registry.Registry | None = None, threshold: float = 0.95, now: datetime | None = None) -> list[tuple[str, Callable]]:
    """The stages of a batch for :class:`factloom.plans.pipeline.Run`."""
    from ..streaming.ingest import Snapshot

    at = now or datetime.now(timezone.utc)

    def documents(spark):
        return spark.read.parquet(f"{work}/{run_id}/download")

    def log(spark):
        return audit.Log(spark, tables.at("chain"))

    def ingest(spark, _):
        landing = Snapshot(spark, tables.at("filings"), FILINGS)
        found = payloads.pending(new_filings(spark), landing.read(), "accession_number")
        if found.isEmpty():
            raise Skip("no new filings")
        return found

    def download(spark, filings):
        return downloaded(filings, fetch, base)

    def parse(spark, got):
        recorded(log(spark), outcomes(got, "download", run_id), at)
        return ixbrl.facts(got.filter("status = 'success'").select("accession_number", "raw_html"))

    def validate(spark, parsed):
        recorded(log(spark), outcomes(parsed, "parse", run_id), at)
        facts = parsed.filter("status = 'success'").drop("status", "detail")
        if facts.isEmpty():
            raise Skip("no facts to validate")
        consolidated = facts.filter("segment is null")
        try:
            quality.require_complete(quality.completeness(consolidated, "accession_number", "fact_name", [PREFIX + r for r in REQUIRED]), threshold)
        except quality.QualityError as e:
            raise StageFailed(str(e)) from e
        return facts

    def score(spark, facts):
        if models is not None:
            rows, run, _ = score_stage(spark, facts, documents(spark), models, run_id, at)
            if rows is not None:
                rows.write.mode("append").parquet(tables.at("anomalies"))
                run.write.mode("append").parquet(tables.at("model_runs"))
        return facts

    def load(spark, facts):
        landing = Snapshot(spark, tables.at("filings"), FILINGS)
        landing.replace(landed(landing.read(), _ready(documents(spark).filter("status = 'success'"), at), run_id))
        target = Snapshot(spark, tables.at("facts"), FACTS)
        target.replace(loaded(target.read(), facts))
        recorded(log(spark), load_outcomes(facts, run_id), at)
        return facts.select("accession_number").distinct()

    def finish(spark, loaded_filings):
        from ..schema import CHAIN_AUDIT, STAGE_AUDIT

        metrics.append_record(metrics.run_record(_read(spark, tables.at("stages"), STAGE_AUDIT), _read(spark, tables.at("chain"), CHAIN_AUDIT), _read(spark, tables.at("model_runs"), MODEL_RUNS), run_id, at.date()), tables.at("metrics"))
        return loaded_filings

    return [("ingest", ingest), ("download", download), ("parse", parse), ("validate", validate), ("score", score), ("load", load), ("audit_trail", finish)]


def run(spark: SparkSession, run_id: str, new_filings: Callable[[SparkSession], DataFrame], fetch: Callable[[str], str], base: str, tables: Tables, work: str, models: registry.Registry | None = None, to: dict[str, alerts.Channel] | None = None, **settings) -> Run:
    """A batch ready to execute: scoring and metrics may fail alone, a failure goes to the channels with the stage that failed first."""
    threshold = settings.pop("threshold", 0.95)
    made = Run(spark, run_id, work, stages(new_filings, fetch, base, tables, run_id, work, models, threshold), frozenset(("score", "audit_trail")), log=tables.at("stages"), **({"pause": 60.0 * PAUSE_MINUTES} | settings))
    made.alert = lambda stage, why: alerts.dispatch(alerts.Alert(run_id, alerts.first_failed(made.audit), why), to or {})
    return made


# Backfill.


class Checkpoint:
    """What is completed of each company, as a small JSON file: {cik: {completed: [...], last_filing_date: ...}}."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> dict[str, dict]:
        """What is there; nothing where the file is missing or can't be read."""
        try:
            found = json.loads(read_text(self.spark, self.path) or "{}")
        except ValueError:
            return {}
        return found if isinstance(found, dict) else {}

    def add(self, done: DataFrame) -> dict[str, dict]:
        """Add completed filings (cik, accession_number, filing_date): united with what is there, sorted; the latest day counts."""
        state = self.read()
        new = done.groupBy("cik").agg(F.sort_array(F.collect_set("accession_number")).alias("completed"), F.max(F.col("filing_date").cast("string")).alias("day")).collect()
        for r in new:
            own = state.get(r["cik"], {"completed": [], "last_filing_date": None})
            state[r["cik"]] = {"completed": sorted({*own["completed"], *r["completed"]}), "last_filing_date": max(filter(None, (own["last_filing_date"], r["day"])), default=None)}
        write_text(self.spark, self.path, json.dumps(state, sort_keys=True))
        return state

    def frame(self) -> DataFrame:
        rows = [(c, x, s.get("last_filing_date")) for c, s in self.read().items() for x in s.get("completed", [])]
        return self.spark.createDataFrame(rows, "cik string, accession_number string, last_filing_date string")


def candidates(payload: DataFrame, choice: str, start: date, end: date, done: DataFrame | None = None, since_last_run: bool = False) -> DataFrame:
    """Filings of submissions payloads to take: by form and inclusive dates, without completed ones.

    since_last_run: a company's start is the later one of ``start`` and its last completed day.
    """
    found = payloads.filings_of(payload, forms(choice), start.isoformat(), end.isoformat())
    if done is None:
        return found
    if since_last_run:
        last = done.groupBy("cik").agg(F.max("last_filing_date").alias("last"))
        found = found.join(last, "cik", "left").filter(F.col("filing_date") >= F.greatest(F.lit(start.isoformat()), F.coalesce("last", F.lit(start.isoformat())))).drop("last")
    return payloads.pending(found, done, "accession_number")


@dataclass(frozen=True)
class Totals:
    filings: int
    facts: int
    failed: int


def backfill(spark: SparkSession, payload: DataFrame, fetch: Callable[[str], str], base: str, tables: Tables, checkpoint: Checkpoint, choice: str, start: date, end: date, resume: bool = False, since_last_run: bool = False, dry_run: bool = False) -> Totals:
    """Take a range of filings: download, parse, land and load, then the checkpoint.  Failed filings stay open for the next time.

    Landing and facts are merges, so a backfill that broke off before its
    checkpoint changes nothing when it is run again.
    """
    from ..storage import stored
    from ..streaming.ingest import Snapshot

    wanted = candidates(payload, choice, start, end, checkpoint.frame() if resume or since_last_run else None, since_last_run)
    if dry_run:
        return Totals(wanted.count(), 0, 0)
    documents = stored(downloaded(wanted, fetch, base), "documents")
    parsed = stored(ixbrl.facts(documents.filter("status = 'success'").select("accession_number", "raw_html")), "parsed")
    bad = parsed.filter("status = 'failed'").select("accession_number").distinct()
    good = documents.filter("status = 'success'").join(bad, "accession_number", "left_anti")
    landing, target = Snapshot(spark, tables.at("filings"), FILINGS), Snapshot(spark, tables.at("facts"), FACTS)
    landing.replace(landed(landing.read(), _ready(good, datetime.now(timezone.utc)), "backfill"))
    facts = parsed.filter("status = 'success'")
    target.replace(loaded(target.read(), facts.drop("status", "detail")))
    checkpoint.add(good)
    total = documents.count()
    ok = good.count()
    return Totals(ok, facts.count(), total - ok)


# Training.


@dataclass(frozen=True)
class Trained:
    version: str | None
    metrics: dict[str, float]


def train(facts: DataFrame, filings: DataFrame, models: registry.Registry | None, holdout: float = 0.2, rate: float = 0.2, seed: int = SEED, promote: bool = False, notes: str = "", provenance: dict | None = None, **settings) -> Trained:
    """Fit on the filings that aren't held out, measure on corrupted held-out ones, register with the baseline beside the model.

    The split is by filing: none has facts on both sides.
    """
    learn, test = detector.holdout(filings, holdout, seed)
    of = lambda own: facts.join(own.select("accession_number"), "accession_number", "left_semi")
    matrix = features.build(of(learn), filings).persist()
    if matrix.limit(2).count() < 2:
        raise ValueError("training needs two filings at least")
    model = detector.Detector(seed=seed, **settings).fit(matrix)
    held = of(test)
    label = detector.corruption(F.col("accession_number"), rate, seed).isNotNull().cast("int")
    rows = model.score(features.build(detector.with_corruption(held, rate, seed), filings)).withColumn("label", label)
    found = detector.evaluated(rows, "label", "score", "is_anomaly", rate, model.threshold, seed).first().asDict()
    if models is None:
        return Trained(None, found)
    n = matrix.count()
    version = models.register(model.to_json(), {"metrics": {k: float(v) for k, v in found.items()}, "n_training_filings": n, "features": list(model.features), "contamination": model.contamination, "threshold": model.threshold, "seed": seed, "notes": notes} | (provenance or {}))
    warehouse.save_baseline(matrix, models.folder(version))
    if promote:
        models.promote(version)
    return Trained(version, found)


def verdict(facts: DataFrame, filings: DataFrame, run_id: str, names: list[str], as_of: date, **settings) -> runs.Report:
    """Validation of a run that is in the warehouse already."""
    return runs.validate(facts, filings, run_id, names, as_of, **settings)


def rule_counts(matrix: DataFrame) -> DataFrame:
    """(rule_id, filings): how many filings break each rule."""
    fired = rules.evaluate(matrix).select(F.explode("violations").alias("v"))
    return fired.groupBy(F.col("v.rule_id").alias("rule_id")).agg(F.count("*").alias("filings"))
