"""Company-year pivot and year-over-year change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PREFIX, REVENUE_ALIAS

METRICS = {
    "revenue": ("Revenues", REVENUE_ALIAS),
    "net_income": ("NetIncomeLoss",),
    "operating_income": ("OperatingIncomeLoss",),
    "total_assets": ("Assets",),
    "total_liabilities": ("Liabilities",),
    "eps_basic": ("EarningsPerShareBasic",),
    "shares_outstanding": ("CommonStockSharesOutstanding",),
}


def pivot(rows: DataFrame, keys: list[str], concept: str, value: str, metrics: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row a key; each metric is the largest value of its concepts.  One partial aggregate, one shuffle on the keys."""
    return rows.groupBy(*keys).agg(*[F.max(F.when(F.col(concept).isin(*names), F.col(value))).alias(m) for m, names in metrics.items()])


def company_year(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Consolidated, dated facts by company, ticker and fiscal year."""
    dated = facts.filter(F.col("segment").isNull() & F.col("period_end").isNotNull()).select("accession_number", "fact_name", "fact_value", F.year("period_end").alias("fiscal_year"))
    joined = dated.join(filings.select("accession_number", "cik", "ticker"), "accession_number")
    return pivot(joined, ["cik", "ticker", "fiscal_year"], "fact_name", "fact_value", {m: tuple(PREFIX + n for n in names) for m, names in METRICS.items()})


def growth_percent(now: Column, before: Column) -> Column:
    """(now - before) * 100 / before to two places; null where before is missing or 0."""
    q = F.try_divide((now - before).cast("decimal(20,4)") * F.lit(100).cast("decimal(5,0)"), before.cast("decimal(20,4)"))
    return F.round(q, 2).cast("decimal(20,2)")


def year_over_year(mart: DataFrame, company: str = "cik", year: str = "fiscal_year", metrics: tuple[str, ...] = ("revenue", "net_income")) -> DataFrame:
    """The mart with each metric of the company's previous row and the change in percent: one window for all."""
    w = Window.partitionBy(company).orderBy(year)
    prior = mart.select("*", *[F.lag(m).over(w).alias(f"prior_year_{m}") for m in metrics])
    return prior.select("*", *[growth_percent(F.col(m), F.col(f"prior_year_{m}")).alias(f"{m}_yoy_growth_pct") for m in metrics])
