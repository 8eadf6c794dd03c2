"""Data-quality gates: completeness and population stability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DRIFT_MIN_SAMPLES, FLAG_RATE_TOLERANCE, PSI_ALERT, PSI_EPSILON, PSI_WARN
from ..storage import stored
from .ranks import running_total


class QualityError(RuntimeError):
    """A gate that did not pass."""


def completeness(facts: DataFrame, key: str, name: str, required: list[str]) -> DataFrame:
    """(key, missing, is_complete): which required names a key lacks.  Only required names are gathered."""
    present = facts.groupBy(key).agg(*[F.max(F.when(F.col(name) == r, True)).alias(f"_{i}") for i, r in enumerate(required)])
    gaps = F.array_compact(F.array(*[F.when(F.col(f"_{i}").isNull(), F.lit(r)) for i, r in enumerate(required)]))
    return present.select(key, gaps.alias("missing")).withColumn("is_complete", F.size("missing") == 0)


def completeness_summary(per_key: DataFrame, threshold: float) -> DataFrame:
    """(total, complete, ratio, passed) over all keys; without keys the ratio is 1."""
    s = per_key.agg(F.count("*").alias("total"), F.count_if("is_complete").alias("complete"))
    ratio = F.when(F.col("total") == 0, F.lit(1.0)).otherwise(F.col("complete") / F.when(F.col("total") == 0, 1).otherwise(F.col("total")))
    return s.withColumn("ratio", ratio).withColumn("passed", F.col("ratio") >= threshold)


def require_complete(per_key: DataFrame, threshold: float = 0.95) -> None:
    row = completeness_summary(per_key, threshold).first()
    if not row["passed"]:
        raise QualityError(f"completeness {row['ratio']:.3f} of {row['total']} is below {threshold}")


def psi_level(psi: Column) -> Column:
    return F.when(psi >= PSI_ALERT, "ALERT").when(psi >= PSI_WARN, "WARN").otherwise("OK")


def uniform_edges(values: DataFrame, by: list[str], value: str, bins: int) -> DataFrame:
    """(by, edges): bins + 1 edges over the whole range, the last a little wider; null where the range is empty."""
    s = values.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    edges = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.when(i == bins, F.col("hi") + 1e-9).otherwise(F.col("lo") + i * step))
    return s.select(*by, F.when(F.col("hi") > F.col("lo"), edges).alias("edges"))


def quantile_edges(counts: DataFrame, by: list[str], value: str, bins: int) -> DataFrame:
    """(by, edges) by nearest rank with half-even rounding; ends open, equal edges once.

    ``counts``: (by, value, n), a row for each distinct value of the baseline.
    Ranks are running sums of n by sorted ranges: no group of values is
    gathered into one row or one task.
    """
    counts = counts.filter("n > 0")
    ranked = running_total(counts, by, value, "n", "upto")
    total = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    joined = ranked.join(total, by) if by else ranked.crossJoin(total)
    position = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda q: F.least(F.bround(q * F.col("total") / F.lit(float(bins)), 0).cast("bigint"), F.col("total") - 1))
    hit = joined.withColumn("q", F.explode(F.filter(position, lambda p: (p >= F.col("upto") - F.col("n")) & (p < F.col("upto")))))
    edges = hit.groupBy(*by).agg(F.sort_array(F.collect_set(value)).alias("e"))
    inner = F.slice("e", 2, F.greatest(F.size("e") - 2, F.lit(0)))
    infinite = F.lit(float("inf"))
    return edges.select(*by, F.when(F.size("e") >= 2, F.concat(F.array(-infinite), inner, F.array(infinite))).alias("edges"))


def psi(values: DataFrame, by: list[str], value: str = "value", bins: int = 10, strategy: str = "uniform") -> DataFrame:
    """(by, psi, level, baseline_count, current_count) of ``values`` (by, value, is_base).

    Bins are [lo, hi); values beyond the last edge fall into the last bin.  A
    share of 0 counts as 1e-4 and nothing is renormalised.  Constant data: 0.
    """
    if strategy not in ("uniform", "quantile"):
        raise ValueError(f"no strategy {strategy}")
    # Equal values fall into one bin: all that follows reads their counts.
    counts = stored(values.groupBy(*by, value).agg(F.count_if("is_base").alias("n"), F.count_if(~F.col("is_base")).alias("m")), "values")
    edges = uniform_edges(counts, by, value, bins) if strategy == "uniform" else quantile_edges(counts.select(*by, value, "n"), by, value, bins)
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    placed = (counts.join(edges, by) if by else counts.crossJoin(edges)).withColumn("bin", F.size(F.filter(inner, lambda e: F.col(value) >= e)))
    # The edges of a group are one value; the bin count follows from them.
    per = placed.groupBy(*by, "bin").agg(F.sum("n").alias("b"), F.sum("m").alias("c"), F.first(F.size("edges") - 1).alias("n_bins"))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("baseline_count"), F.sum("m").alias("current_count"))
    shares = per.join(totals, by) if by else per.crossJoin(totals)
    floor = lambda n, total: F.greatest(F.try_divide(n, total), F.lit(PSI_EPSILON))
    e, a = floor(F.col("b"), F.col("baseline_count")), floor(F.col("c"), F.col("current_count"))
    out = shares.withColumn("term", F.when(F.col("n_bins") > 0, (a - e) * F.ln(a / e)).otherwise(F.lit(0.0))).groupBy(*by).agg(F.round(F.sum("term"), 9).alias("psi"), F.first("baseline_count").alias("baseline_count"), F.first("current_count").alias("current_count"))
    return out.withColumn("level", psi_level(F.col("psi")))


def feature_drift(baseline: DataFrame, current: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """Quantile PSI, level, counts and means of each feature column, actionable from WARN and 30 samples on."""
    long = lambda df, base: df.select(*features).unpivot([], features, "feature", "value").withColumn("is_base", F.lit(base))
    both = long(baseline, True).unionByName(long(current, False)).filter(F.col("value").isNotNull())
    means = both.groupBy("feature").agg(F.avg(F.when(F.col("is_base"), F.col("value"))).alias("baseline_mean"), F.avg(F.when(~F.col("is_base"), F.col("value"))).alias("current_mean"))
    out = psi(both, ["feature"], bins=bins, strategy="quantile").join(means, "feature")
    return out.withColumn("is_actionable", F.col("level").isin("WARN", "ALERT") & (F.col("current_count") >= DRIFT_MIN_SAMPLES))


def prediction_drift(scores: DataFrame, threshold: float, bins: int = 10) -> DataFrame:
    """Quantile PSI of ``scores`` (value, is_base) with both flag rates and whether their ratio is out of tolerance."""
    rates = scores.agg(F.avg(F.when(F.col("is_base"), (F.col("value") >= threshold).cast("double"))).alias("baseline_flag_rate"), F.avg(F.when(~F.col("is_base"), (F.col("value") >= threshold).cast("double"))).alias("current_flag_rate"))
    out = psi(scores, [], bins=bins, strategy="quantile").crossJoin(rates)
    ratio = F.try_divide("current_flag_rate", "baseline_flag_rate")
    return out.withColumn("flag_rate_anomalous", F.coalesce((ratio > FLAG_RATE_TOLERANCE) | (ratio < 1 / FLAG_RATE_TOLERANCE), F.lit(False)))
