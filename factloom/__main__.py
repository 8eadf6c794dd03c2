"""python -m factloom COMMAND: validate, runs, train, gate, backfill, verify, demo.

Tables are folders below --tables: filings and facts (snapshots), chain,
stages, metrics.  Exit codes: 0 all is well, 1 something failed, 2 it could
not be looked at.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import audit, detector, features, quality, registry, runs
from .plans import batch
from .schema import FACTS, FILINGS, PREFIX, REQUIRED, STAGE_AUDIT
from .session import session
from .sources import payloads, synthetic, warehouse
from .sources.client import Fetcher
from .storage import exists
from .streaming.ingest import Snapshot


@contextmanager
def timed(name: str, into: dict[str, float]) -> Iterator[None]:
    """Seconds that a step takes."""
    began = time.perf_counter()
    try:
        yield
    finally:
        into[name] = round(time.perf_counter() - began, 3)


def _tables(spark: SparkSession, root: str):
    at = batch.Tables(root)
    return Snapshot(spark, at.at("facts"), FACTS).read(), Snapshot(spark, at.at("filings"), FILINGS).read(), at


def list_runs(spark: SparkSession, a: argparse.Namespace) -> int:
    where = batch.Tables(a.tables).at("stages")
    if not exists(spark, where):
        print("no runs yet")
        return 0
    for r in runs.recent(spark.read.schema(STAGE_AUDIT).parquet(where)).collect():
        print(f"{r['run_id']}  {r['stage']}  {r['status']}  {r['records_processed']}  {r['created_at']}")
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    facts, filings, _ = _tables(spark, a.tables)
    report = runs.validate(facts, filings, a.run_id, a.facts or [PREFIX + r for r in REQUIRED], a.as_of, a.days, a.threshold)
    print(report.text())
    return report.exit_code


def train(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.synthetic:
        facts, filings = synthetic.corpus(spark, a.companies, a.years)
    else:
        facts, filings, _ = _tables(spark, a.tables)
        facts, filings = warehouse.training(filings, facts, a.since, a.limit)
    models = None if a.no_register else registry.Registry(a.models)
    try:
        got = batch.train(facts, filings, models, a.holdout, a.rate, a.seed, a.promote, a.notes, registry.provenance())
    except ValueError as e:
        print(e)
        return 2
    if a.metrics_out:
        Path(a.metrics_out).write_text(json.dumps(got.metrics, indent=2, sort_keys=True))
    print(json.dumps({"version": got.version} | got.metrics, indent=2, sort_keys=True))
    return 0


def gate(spark: SparkSession | None, a: argparse.Namespace) -> int:
    try:
        candidate = registry.figures(Path(a.candidate).read_text())
        before = registry.figures(Path(a.before).read_text()) if a.before else None
    except (OSError, KeyError, ValueError) as e:
        print(f"figures can't be read: {e}")
        return 2
    why = detector.gate(candidate, before)
    text = registry.gate_summary(candidate, before, why)
    if a.summary:
        Path(a.summary).write_text(text)
    print(text)
    return int(bool(why))


def fetcher() -> Fetcher:
    import urllib.request

    def get(url: str):
        with urllib.request.urlopen(url) as r:
            return r.status, dict(r.headers), r.read().decode("utf-8", "replace")

    return Fetcher(get)


def backfill(spark: SparkSession, a: argparse.Namespace) -> int:
    payload = payloads.submissions(spark, a.submissions)
    held: dict[str, Fetcher] = {}

    def fetch(url: str) -> str:
        # A task makes its own: what holds a lock can't go there.
        return held.setdefault("fetcher", fetcher()).fetch(url)

    tables = batch.Tables(a.tables)
    got = batch.backfill(spark, payload, fetch, a.base, tables, batch.Checkpoint(spark, a.checkpoint or tables.at("checkpoint.json")), a.form, a.start, a.end, a.resume, a.since_last_run, a.dry_run)
    print(f"{got.filings} filings, {got.facts} facts, {got.failed} failed")
    return int(got.failed > 0)


def verify(spark: SparkSession, a: argparse.Namespace) -> int:
    where = batch.Tables(a.tables).at("chain")
    if not exists(spark, where):
        print("there is no chain")
        return 2
    r = audit.Log(spark, where).verify().first()
    print(f"{r['total_rows']} rows, " + ("the chain holds" if r["valid"] else f"broken at {r['broken_at']}: {r['broken_reason']}"))
    return int(not r["valid"])


def demo(spark: SparkSession, a: argparse.Namespace) -> int:
    """Features, rules, completeness and scores of an invented corpus, with the seconds of each step."""
    took: dict[str, float] = {}
    facts, filings = synthetic.corpus(spark, a.companies, a.years)
    with timed("features", took):
        matrix = features.build(facts, filings).persist()
        n = matrix.count()
    with timed("fit", took):
        model = detector.Detector(trees=60).fit(matrix)
    with timed("score", took):
        counts = detector.flagged(model.score(matrix)).first()
    with timed("completeness", took):
        complete = quality.completeness_summary(quality.completeness(facts, "accession_number", "fact_name", [PREFIX + r for r in REQUIRED]), 0.95).first()
    print(json.dumps({"filings": n, "flagged": counts["flagged"], "violating": counts["violating"], "complete": complete["ratio"], "seconds": took}, indent=2))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="factloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(required=True)

    def command(name: str, run, spark: bool = True) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.set_defaults(run=run, spark=spark)
        c.add_argument("--tables", default=os.environ.get("FACTLOOM_TABLES", "warehouse"))
        return c

    command("runs", list_runs)
    c = command("validate", validate)
    c.add_argument("run_id")
    c.add_argument("--facts", nargs="*")
    c.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    c.add_argument("--days", type=int, default=730)
    c.add_argument("--threshold", type=float, default=0.95)
    c = command("train", train)
    c.add_argument("--synthetic", action="store_true")
    c.add_argument("--companies", type=int, default=120)
    c.add_argument("--years", type=int, default=5)
    c.add_argument("--since", type=date.fromisoformat)
    c.add_argument("--limit", type=int)
    c.add_argument("--models", default="models")
    c.add_argument("--holdout", type=float, default=0.2)
    c.add_argument("--rate", type=float, default=0.2)
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--notes", default="")
    c.add_argument("--metrics-out")
    c.add_argument("--promote", action="store_true")
    c.add_argument("--no-register", action="store_true")
    c = command("gate", gate, spark=False)
    c.add_argument("candidate")
    c.add_argument("--before")
    c.add_argument("--summary")
    c = command("backfill", backfill)
    c.add_argument("submissions")
    c.add_argument("--base", required=True)
    c.add_argument("--form", choices=sorted(batch.FORMS), default="both")
    c.add_argument("--start", type=date.fromisoformat, required=True)
    c.add_argument("--end", type=date.fromisoformat, required=True)
    c.add_argument("--checkpoint")
    for flag in ("--resume", "--since-last-run", "--dry-run"):
        c.add_argument(flag, action="store_true")
    command("verify", verify)
    c = command("demo", demo)
    c.add_argument("--companies", type=int, default=40)
    c.add_argument("--years", type=int, default=4)
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    return a.run((spark or session()) if a.spark else None, a)


if __name__ == "__main__":
    sys.exit(main())
