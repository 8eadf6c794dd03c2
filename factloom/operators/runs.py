"""Validation of a run: its stages, the completeness of its filings, and the drift of values between two windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..schema import PREFIX, REQUIRED
from . import quality

LISTED, SHOWN = 40, 10


def recent(audit: DataFrame, limit: int = LISTED) -> DataFrame:
    """The newest stage rows of all runs; equal times by id."""
    return audit.select("run_id", "stage", "status", F.coalesce("records_processed", F.lit(0)).alias("records_processed"), "created_at", "id").orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def facts_of_run(facts: DataFrame, filings: DataFrame, run_id: str) -> DataFrame:
    """(accession_number, fact_name): consolidated facts of the filings that a run landed."""
    own = filings.filter(F.col("pipeline_run_id") == run_id).select("accession_number")
    return facts.filter(F.col("segment").isNull()).join(own, "accession_number", "left_semi").select("accession_number", "fact_name")


def names_by_filing(facts: DataFrame) -> DataFrame:
    """(accession_number, names): the distinct concepts of each filing, sorted."""
    return facts.groupBy("accession_number").agg(F.sort_array(F.collect_set("fact_name")).alias("names"))


def accessions(rows: DataFrame) -> DataFrame:
    """Distinct accession numbers, sorted."""
    return rows.select("accession_number").filter("accession_number is not null").distinct().orderBy("accession_number")


def windows(facts: DataFrame, names: list[str], as_of: date, days: int) -> DataFrame:
    """(fact_name, value, is_base): consolidated values of two windows before a day, the older one the base.

    The base begins ``days`` before the day and ends where the current window
    begins, ``days // 2`` before it; the current one is open to the right.
    """
    start, middle = as_of - timedelta(days=days), as_of - timedelta(days=days // 2)
    own = facts.filter(F.col("fact_name").isin(*names) & F.col("segment").isNull() & F.col("fact_value").isNotNull() & (F.col("period_end") >= F.lit(start)))
    return own.select("fact_name", F.col("fact_value").cast("double").alias("value"), (F.col("period_end") < F.lit(middle)).alias("is_base"))


def drift(facts: DataFrame, names: list[str], as_of: date, days: int) -> DataFrame:
    """PSI between the two windows of each concept that has values in both."""
    return quality.psi(windows(facts, names, as_of, days), ["fact_name"]).filter("baseline_count > 0 and current_count > 0")


def result(per_filing: DataFrame, run_id: str, threshold: float) -> DataFrame:
    """One row: run_id, total, complete, ratio, passed, and missing, a map from filings to what they lack.

    The map holds the first filings by number, as a report shows them; all are counted.
    """
    lacking = per_filing.filter(~F.col("is_complete")).select("accession_number", "missing").orderBy("accession_number").limit(SHOWN)
    shown = lacking.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("accession_number", "missing")))).alias("missing"))
    return quality.completeness_summary(per_filing, threshold).select(F.lit(run_id).alias("run_id"), "*").crossJoin(shown)


@dataclass(frozen=True)
class Report:
    """completeness: the row of :func:`result`, None for a run without facts; drift: PSI rows; exit_code: 0 if all is well, else 1."""

    completeness: Row | None
    drift: list[Row]

    @property
    def exit_code(self) -> int:
        incomplete = self.completeness is not None and not self.completeness["passed"]
        return int(incomplete or any(r["level"] == "ALERT" for r in self.drift))

    def text(self) -> str:
        lines = []
        if self.completeness is None:
            lines.append("no facts of this run")
        else:
            c = self.completeness
            lines.append(f"complete: {c['complete']} of {c['total']} ({c['ratio']:.1%}), {'passed' if c['passed'] else 'failed'}")
            lines += [f"  {k}: {', '.join(v)}" for k, v in sorted(c["missing"].items())]
            if (more := c["total"] - c["complete"] - len(c["missing"])) > 0:
                lines.append(f"  and {more} more")
        lines += [f"{r['fact_name']}: {r['psi']:.4f} {r['level']}" for r in self.drift] or ["no values to compare"]
        return "\n".join(lines)


def validate(facts: DataFrame, filings: DataFrame, run_id: str, names: list[str], as_of: date, days: int = 730, threshold: float = 0.95) -> Report:
    """What a run's filings lack, and how the concepts drift."""
    own = facts_of_run(facts, filings, run_id)
    per = quality.completeness(own, "accession_number", "fact_name", [PREFIX + r for r in REQUIRED])
    row = result(per, run_id, threshold).first()
    return Report(row if row["total"] else None, drift(facts, names, as_of, days).orderBy("fact_name").collect())
