"""The warehouse's tables and marts as SQL views, and its table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts
from ..schema import ANOMALIES, CHAIN_AUDIT, FACTS, FILINGS, MODEL_RUNS, STAGE_AUDIT, VERSIONS
from ..sources import ixbrl

TABLES = {"financial_facts": FACTS, "filings_raw": FILINGS, "filing_versions": VERSIONS, "pipeline_audit": STAGE_AUDIT, "extraction_audit": CHAIN_AUDIT, "model_runs": MODEL_RUNS, "anomaly_scores": ANOMALIES}
MARTS = ("mart_company_year", "mart_company_yoy")


def up(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register the given tables, empty ones for those that aren't given, the marts over them, and the table functions."""
    held = {name: tables[name] if name in tables else spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    for name, df in held.items():
        df.createOrReplaceTempView(name)
    mart = marts.company_year(held["financial_facts"], held["filings_raw"])
    mart.createOrReplaceTempView(MARTS[0])
    marts.year_over_year(mart).createOrReplaceTempView(MARTS[1])
    ixbrl.register(spark)
    return [*held, *MARTS]


def down(spark: SparkSession) -> None:
    for name in (*MARTS, *TABLES):
        spark.catalog.dropTempView(name)
