"""The feature vector of a filing, from facts and filing metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bare_concept, finite, safe_ratio, signed_log
from ..schema import CLIP, CONCEPTS, FEATURES, REQUIRED, REVENUE_ALIAS
from .facts import latest_period, period_days


def _clip(x: Column) -> Column:
    return F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), x))


def eps_consistency(net_income: Column, shares: Column, eps: Column) -> Column:
    """Net income over eps times shares, clipped, less one; 0 where a part is missing or the product is 0."""
    product = eps * shares
    return F.when(net_income.isNull() | product.isNull() | (product == 0), F.lit(0.0)).otherwise(_clip(safe_ratio(net_income, product) - 1.0))


def change_log(now: Column, before: Column) -> Column:
    """log10 |now / before| with the clip; 0 where either is missing or 0."""
    fine = now.isNotNull() & before.isNotNull() & (before != 0) & (now != 0)
    return F.when(fine, _clip(F.log10(F.abs(F.when(fine, now).otherwise(1.0) / F.when(fine, before).otherwise(1.0))))).otherwise(F.lit(0.0))


def coverage(names: tuple[str, ...]) -> Column:
    """The share of these columns that have a value."""
    return sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0)) / F.lit(float(len(names)))


def with_prior(rows: DataFrame, company: str, order: list[str], values: list[str], name: str) -> DataFrame:
    """``rows`` with a struct of the values that the company's row before has; null for the first one and without a company."""
    w = Window.partitionBy(company).orderBy(*order)
    return rows.withColumn(name, F.when(F.col(company).isNotNull(), F.lag(F.struct(*values)).over(w)))


def column(matrix: DataFrame, name: str) -> DataFrame:
    """(accession_number, value) of one feature; KeyError names one that isn't there."""
    if name not in matrix.columns or name == "accession_number":
        raise KeyError(name)
    return matrix.select("accession_number", F.col(name).alias("value"))


def row(matrix: DataFrame, accession: str) -> dict[str, float]:
    """One filing's features by name; KeyError for a filing that isn't there."""
    found = matrix.filter(F.col("accession_number") == accession).first()
    if found is None:
        raise KeyError(accession)
    return {k: v for k, v in found.asDict().items() if k != "accession_number"}


def by_concept(facts: DataFrame, consolidated_only: bool = True) -> DataFrame:
    """(accession_number, facts): each filing's latest value of every known concept, as a map.  A map has one entry a concept."""
    named = facts.filter(F.col("accession_number").isNotNull()).withColumn("concept", bare_concept(F.col("fact_name")))
    named = named.withColumn("concept", F.when(F.col("concept") == REVENUE_ALIAS, CONCEPTS[0]).otherwise(F.col("concept"))).withColumn("value", finite(F.col("fact_value")))
    usable = named.filter(F.col("value").isNotNull() & F.col("concept").isin(*CONCEPTS))
    picked = latest_period(usable, ["accession_number", "concept"], "period_end", "ord", consolidated_only)
    return picked.groupBy("accession_number").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("concept", "value")))).alias("facts"))


def build(facts: DataFrame, filings: DataFrame | None = None, consolidated_only: bool = True) -> DataFrame:
    """(accession_number, the features in order) for each filing with a usable fact.

    One shuffle on (accession, concept) picks values; a second on the company
    finds the filing before.  Period lengths use all rows of a filing.
    """
    named = facts.filter(F.col("accession_number").isNotNull()).withColumn("concept", bare_concept(F.col("fact_name")))
    named = named.withColumn("concept", F.when(F.col("concept") == REVENUE_ALIAS, CONCEPTS[0]).otherwise(F.col("concept"))).withColumn("value", finite(F.col("fact_value")))
    usable = named.filter(F.col("value").isNotNull() & F.col("concept").isin(*CONCEPTS))
    picked = latest_period(usable, ["accession_number", "concept"], "period_end", "ord", consolidated_only)
    wide = picked.groupBy("accession_number").agg(*[F.max(F.when(F.col("concept") == c, F.col("value"))).alias(c) for c in CONCEPTS])
    wide = wide.join(period_days(facts, "accession_number", "period_start", "period_end"), "accession_number", "left")
    if filings is not None:
        meta = filings.select("accession_number", F.col("cik").alias("_cik"), F.coalesce("period_of_report", "filing_date").alias("_period"))
        wide = wide.join(meta, "accession_number", "left")
        wide = with_prior(wide, "_cik", ["_period", "accession_number"], ["Revenues", "Assets"], "_prior")
        before = {"Revenues": F.col("_prior.Revenues"), "Assets": F.col("_prior.Assets")}
    else:
        before = {"Revenues": F.lit(None).cast("double"), "Assets": F.lit(None).cast("double")}
    c = {name: F.col(name) for name in CONCEPTS}
    values = (
        signed_log(c["Assets"]),
        signed_log(c["Revenues"]),
        safe_ratio(c["NetIncomeLoss"], c["Revenues"]),
        safe_ratio(c["OperatingIncomeLoss"], c["Revenues"]),
        safe_ratio(c["Liabilities"], c["Assets"]),
        safe_ratio(c["NetIncomeLoss"], c["Assets"]),
        safe_ratio(c["Revenues"], c["Assets"]),
        eps_consistency(c["NetIncomeLoss"], c["CommonStockSharesOutstanding"], c["EarningsPerShareBasic"]),
        change_log(c["Revenues"], before["Revenues"]),
        change_log(c["Assets"], before["Assets"]),
        coverage(CONCEPTS),
        coverage(REQUIRED),
        F.least(F.coalesce("period_days", F.lit(0)) / F.lit(366.0), F.lit(CLIP)),
    )
    return wide.select("accession_number", *[v.alias(n) for n, v in zip(FEATURES, values, strict=True)])
