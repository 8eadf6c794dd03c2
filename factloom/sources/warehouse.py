"""Scans of the warehouse tables for scoring and training, the baseline beside a model, and a small cache."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CACHE_TTL_SECONDS, FACTS, FILINGS, PREFIX
from ..storage import exists, remove
from .payloads import fresh

METADATA = ("accession_number", "cik", "ticker", "filing_type", "filing_date", "period_of_report")


def raw_html(filings: DataFrame, wanted: DataFrame) -> DataFrame:
    """(accession_number, raw_html) of the wanted filings that have a document."""
    there = filings.filter(F.length("raw_html") > 0).select("accession_number", "raw_html")
    return there.join(wanted.select("accession_number"), "accession_number", "left_semi")


def metadata(filings: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted filings without their documents."""
    return filings.select(*METADATA).join(wanted.select("accession_number"), "accession_number", "left_semi")


def training(filings: DataFrame, facts: DataFrame, since: date | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts, filings) to train on: filings from a day on, the newest ``limit`` of them, and their facts."""
    own = filings.select(*METADATA)
    own = own.filter(F.col("filing_date") >= F.lit(since)) if since else own
    own = own.orderBy(F.col("filing_date").desc(), "accession_number").limit(limit) if limit else own
    return facts.join(own.select("accession_number"), "accession_number", "left_semi"), own


def save_baseline(matrix: DataFrame, version_dir: str) -> None:
    """The feature matrix that a model was fitted on, beside the model."""
    matrix.write.mode("overwrite").parquet(f"{version_dir}/baseline_features")


def baseline(spark: SparkSession, version_dir: str) -> DataFrame | None:
    """The matrix beside a model; None if there is none, as a first run has nothing to drift from."""
    to = f"{version_dir}/baseline_features"
    return spark.read.parquet(to) if exists(spark, to) else None


def mock(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(filings, facts): two filings of invented companies, complete and consistent, for runs without a network."""
    at = [("0000000001-24-000001", "1", "AAAA", 1.0e9), ("0000000002-24-000001", "2", "BBBB", 4.0e8)]
    ends = date(2023, 12, 31)
    filings = [(a, c, t, "10-K", date(2024, 2, 15), ends, "<html></html>", 13, datetime(2024, 2, 16), "mock") for a, c, t, _ in at]
    share = {"Revenues": 1.0, "NetIncomeLoss": 0.1, "OperatingIncomeLoss": 0.15, "Assets": 2.0, "Liabilities": 1.1, "EarningsPerShareBasic": None, "CommonStockSharesOutstanding": None}
    facts = []
    for a, _, _, revenue in at:
        for n, (name, k) in enumerate(share.items()):
            value = revenue * k if k is not None else (2.0 if name == "EarningsPerShareBasic" else revenue * 0.05)
            facts.append((a, PREFIX + name, value, "USD", date(2023, 1, 1), ends, None, n))
    rows = spark.createDataFrame(facts, FACTS.replace("decimal(20,4)", "double"))
    return spark.createDataFrame(filings, FILINGS), rows.withColumn("fact_value", F.col("fact_value").cast("decimal(20,4)"))


class Cache:
    """Rows by kind and key with an age limit: a folder for each kind.  What can't be read is a miss, never an error."""

    def __init__(self, spark: SparkSession, root: str, ttl: dict[str, int] = CACHE_TTL_SECONDS):
        self.spark, self.root, self.ttl = spark, root, ttl

    def put(self, kind: str, rows: DataFrame, now: datetime) -> None:
        rows.withColumn("cached_at", F.lit(now)).write.mode("append").parquet(f"{self.root}/{kind}")

    def get(self, kind: str, key: str, value: str, now: datetime) -> DataFrame | None:
        """The newest rows of a key that are young enough, or None."""
        try:
            own = fresh(self.spark.read.parquet(f"{self.root}/{kind}"), self.ttl[kind], now).filter(F.col(key) == value)
            last = own.agg(F.max("cached_at")).first()[0]
        except Exception:  # noqa: BLE001  a cache that can't be read has nothing
            return None
        return None if last is None else own.filter(F.col("cached_at") == F.lit(last)).drop("cached_at")

    def left(self, kind: str, key: str, value: str, now: datetime) -> int:
        """Seconds that a key still counts; -2 if it isn't there."""
        try:
            last = self.spark.read.parquet(f"{self.root}/{kind}").filter(F.col(key) == value).agg(F.max("cached_at")).first()[0]
        except Exception:  # noqa: BLE001
            return -2
        seconds = -2 if last is None else int((last + timedelta(seconds=self.ttl[kind]) - now).total_seconds())
        return seconds if seconds > 0 else -2

    def evict(self, kind: str) -> None:
        remove(self.spark, f"{self.root}/{kind}")

    def ping(self) -> bool:
        """Whether the folder can be reached."""
        try:
            return exists(self.spark, self.root)
        except Exception:  # noqa: BLE001
            return False
