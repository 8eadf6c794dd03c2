"""Answers of the read service: one nested row each, with plain values inside.

A web layer turns them into JSON; here they are frames, so that a caller can
also join or store them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import as_json, plain, violations
from . import chunks, retrieve, serve
from .registry import Registry


def _gathered(rows: DataFrame, name: str) -> DataFrame:
    """One row with all rows as a list of structs, in their order: for pages, whose size is bounded by their limit."""
    plain_rows = plain(rows)
    numbered = plain_rows.select(F.struct(F.monotonically_increasing_id().alias("at"), F.struct(*plain_rows.columns).alias("row")).alias("r"))
    return numbered.agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["row"]).alias(name))


def health(spark: SparkSession, cached: Callable[[], bool] | None = None) -> dict[str, str]:
    """Whether a query runs and the cache can be reached."""
    def said(works: Callable[[], bool]) -> str:
        try:
            return "ok" if works() else "unavailable"
        except Exception:  # noqa: BLE001  a probe tells, it doesn't fail
            return "unavailable"

    database = said(lambda: spark.sql("select 1").first()[0] == 1)
    return {"status": "ok" if database == "ok" else "degraded", "database": database, "cache": "disabled" if cached is None else said(cached)}


def filings(table: DataFrame, ticker: str, limit: int = 50, offset: int = 0) -> DataFrame:
    """(ticker, total, limit, offset, items)."""
    page = serve.filings_page(table, ticker, limit, offset)
    total = table.filter(F.upper("ticker") == ticker.upper()).agg(F.count("*").alias("total"))
    head = total.select(F.lit(ticker.upper()).alias("ticker"), "total", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"))
    return head.crossJoin(_gathered(page.drop("total"), "items"))


def filing(facts: DataFrame, table: DataFrame, accession: str) -> DataFrame:
    """(accession_number, filing_type, period_of_report, facts); NotFound for an unknown filing."""
    rows = serve.facts_of_filing(facts, accession, table)
    head = plain(table.filter(F.col("accession_number") == accession).select("accession_number", "filing_type", "period_of_report").limit(1))
    return head.crossJoin(_gathered(rows, "facts"))


def series(facts: DataFrame, table: DataFrame, ticker: str, fact_name: str, segment: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """(ticker, fact_name, series)."""
    rows = serve.time_series(facts, table, ticker, fact_name, segment, limit, offset)
    return _gathered(rows, "series").select(F.lit(ticker.upper()).alias("ticker"), F.lit(fact_name).alias("fact_name"), "series")


def anomalies(scores: DataFrame, table: DataFrame, runs: DataFrame, ticker: str, min_score: float = 0.0, flagged_only: bool = False, limit: int = 50, offset: int = 0) -> DataFrame:
    """(ticker, total, limit, offset, items); violations come as a list, an empty one where they can't be read."""
    queue = lambda n, at: serve.anomaly_queue(scores, table, runs, ticker, min_score, flagged_only, n, at)
    total = serve.anomaly_matches(scores, table, runs, ticker, min_score, flagged_only).agg(F.count("*").alias("total"))
    rows = queue(limit, offset)
    if dict(rows.dtypes).get("rule_violations") == "string":
        rows = rows.withColumn("rule_violations", violations(F.col("rule_violations")))
    head = total.select(F.lit(ticker.upper()).alias("ticker"), "total", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"))
    return head.crossJoin(_gathered(rows, "items"))


def audit(log: DataFrame, accession: str, limit: int = 100) -> DataFrame:
    """(accession_number, total, items), newest first."""
    total = log.filter(F.col("accession_number") == accession).agg(F.count("*").alias("total"))
    return total.select(F.lit(accession).alias("accession_number"), "total").crossJoin(_gathered(serve.audit_history(log, accession, limit), "items"))


def current_model(models: Registry) -> dict:
    """What is known of the model in production, and whether it still is what was registered; NotFound without one."""
    version = models.production()
    if version is None:
        raise serve.NotFound("no model is in production")
    try:
        meta = models.metadata(version)
    except OSError as e:
        raise serve.NotFound(version) from e
    return meta | {"verified": models.verify(version)}


def ask(table: DataFrame, ticker: str, question: str, top_k: int = 5, base: str = "", rephrase: Callable[[str], str] | None = None) -> DataFrame:
    """(ticker, question, answer, grounded, citations) from the documents of a company's filings; NotFound if it has none.

    ``rephrase`` may word a grounded answer anew; one that fails leaves it as it is.
    """
    own = table.filter((F.upper("ticker") == ticker.upper()) & (F.length("raw_html") > 0))
    if own.isEmpty():
        raise serve.NotFound(ticker)
    text = own.select("accession_number", "cik", "filing_type", chunks.strip_html(F.col("raw_html")).alias("text"))
    cut = chunks.chunked(text.select("accession_number", "text"), "accession_number", "text").withColumn("chunk_id", F.concat_ws("#", "accession_number", "chunk_index"))
    post = retrieve.postings(cut, "chunk_id", "text")
    idfs = retrieve.idf(post, "chunk_id")
    asked = table.sparkSession.createDataFrame([(1, question)], "item_id bigint, question string")
    wanted = retrieve.weights(retrieve.postings(asked, "item_id", "question"), idfs, "item_id")
    top = retrieve.cosine_topk(retrieve.weights(post, idfs, "chunk_id"), wanted, "chunk_id", "item_id", top_k)
    rich = top.join(cut.select("chunk_id", "accession_number", "section", "text"), "chunk_id").join(text.select("accession_number", F.col("filing_type").alias("form_type")), "accession_number").crossJoin(asked.select("question"))
    got = asked.join(retrieve.answers(rich, "item_id"), "item_id", "left")
    of = text.select("accession_number", "cik")
    cited = retrieve.sourced(got.select("item_id", F.explode_outer("citations").alias("c")).select("item_id", "c.*").join(of, "accession_number"), base)
    listed = cited.groupBy("item_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.struct("accession_number", "section", "snippet", "source_url", "score").alias("c")))), lambda x: x["c"]).alias("citations"))
    none = F.lit("The filings at hand don't answer this.")
    out = got.drop("citations").join(listed, "item_id", "left")
    said = out.select(F.lit(ticker.upper()).alias("ticker"), "question", F.coalesce("text", none).alias("answer"), F.coalesce("grounded", F.lit(False)).alias("grounded"), "citations")
    if rephrase is None:
        return said
    one = said.first()
    try:
        text = rephrase(one["answer"]) if one["grounded"] else one["answer"]
    except Exception:  # noqa: BLE001  an outside service is an extra
        text = one["answer"]
    return said.withColumn("answer", F.lit(text))


def trigger(table: DataFrame, ticker: str, start: Callable[[str, str | None], str] | None = None) -> dict:
    """Start an ingestion of a company; ``start`` gives the id of the run.  Without it, what is known is told."""
    try:
        cik = serve.company_id(table, ticker)
    except serve.NotFound:
        cik = None
    said = f"run {start(ticker.upper(), cik)} is queued" if start else "no runner is set"
    return {"ticker": ticker.upper(), "cik": cik, "status": "queued", "message": said}


def as_document(answer: DataFrame) -> dict:
    """An answer of one row as a dictionary, by way of JSON."""
    return json.loads(answer.select(as_json(answer).alias("j")).first()[0])
