"""Parameterised read queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import checked, ticker_is
from .merge import keep_newest


class NotFound(LookupError):
    """What was asked for isn't there."""


def page(rows: DataFrame, order: list, limit: int, offset: int) -> DataFrame:
    """A page of rows in a total order; a top-k plan, not a full sort."""
    return rows.orderBy(*order).offset(checked("offset", offset, 0)).limit(limit)


def company_id(filings: DataFrame, ticker: str) -> str:
    """The company of a ticker; the smallest id if there are several."""
    found = filings.filter(ticker_is("ticker", ticker)).agg(F.min("cik")).first()[0]
    if found is None:
        raise NotFound(ticker)
    return found


def filings_page(filings: DataFrame, ticker: str, limit: int = 50, offset: int = 0) -> DataFrame:
    """Newest first, with the total beside each row."""
    own = filings.filter(ticker_is("ticker", ticker)).drop("raw_html")
    total = own.agg(F.count("*").alias("total"))
    return page(own.crossJoin(F.broadcast(total)), [F.col("filing_date").desc(), F.col("accession_number")], checked("limit", limit, 1, 200), offset)


def facts_of_filing(facts: DataFrame, accession: str, filings: DataFrame | None = None) -> DataFrame:
    """The facts of one filing; NotFound if ``filings`` doesn't have it."""
    if filings is not None and filings.filter(F.col("accession_number") == accession).isEmpty():
        raise NotFound(accession)
    return facts.filter(F.col("accession_number") == accession).orderBy("fact_name", F.col("period_end").asc_nulls_last(), "ord")


def time_series(facts: DataFrame, filings: DataFrame, ticker: str, fact_name: str, segment: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """One concept of a company by period; consolidated unless a segment is named."""
    own = facts.filter((F.col("fact_name") == fact_name) & (F.col("segment").isNull() if segment is None else F.col("segment") == segment))
    mine = filings.filter(ticker_is("ticker", ticker)).select("accession_number", "filing_date")
    return page(own.join(mine, "accession_number"), [F.col("period_end").asc_nulls_last(), "accession_number"], checked("limit", limit, 1, 500), offset)


def latest_scores(scores: DataFrame, key: str, newest: str) -> DataFrame:
    """The newest score of each key: chosen before any filter on scores.  One maximum a key, combined before the shuffle."""
    return keep_newest(scores, [key], newest)


def latest_by_id(scores: DataFrame, key: str, newest: str) -> DataFrame:
    """The rows whose id is the largest of their key: a semi-join against the maxima."""
    top = scores.groupBy(key).agg(F.max(newest).alias(newest)).select(newest)
    return scores.join(top, newest, "left_semi")


def anomaly_matches(anomalies: DataFrame, filings: DataFrame, runs: DataFrame, ticker: str, min_score: float = 0.0, flagged_only: bool = False) -> DataFrame:
    """The newest scores of a company's filings that a review asks for, with their model's version."""
    mine = filings.filter(ticker_is("ticker", ticker)).select("accession_number", "ticker", "filing_date")
    latest = latest_scores(anomalies.join(mine, "accession_number"), "accession_number", "id")
    kept = latest.filter(F.col("score") >= checked("min_score", min_score, 0, 1))
    kept = kept.filter("is_anomaly") if flagged_only else kept
    return kept.join(runs.select(F.col("id").alias("model_run_id"), "model_version"), "model_run_id")


def anomaly_queue(anomalies: DataFrame, filings: DataFrame, runs: DataFrame, ticker: str, min_score: float = 0.0, flagged_only: bool = False, limit: int = 50, offset: int = 0) -> DataFrame:
    """The review queue of a company, highest score first."""
    return page(anomaly_matches(anomalies, filings, runs, ticker, min_score, flagged_only), [F.col("score").desc(), F.col("accession_number")], checked("limit", limit, 1, 200), offset)


def audit_history(log: DataFrame, accession: str, limit: int = 100) -> DataFrame:
    return page(log.filter(F.col("accession_number") == accession), [F.col("id").desc()], checked("limit", limit, 1, 500), 0)
