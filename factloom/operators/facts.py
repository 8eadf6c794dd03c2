"""Fact rows: latest period, supersession, durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_period(facts: DataFrame, keys: list[str], period: str, order: str, consolidated_only: bool = True) -> DataFrame:
    """For each key the row of the latest period, undated last; of equals the first by ``order``, then by all columns in turn.

    One minimum a key, combined before the shuffle; columns must have an order.
    """
    rows = facts.filter(F.col("segment").isNull()) if consolidated_only and "segment" in facts.columns else facts
    days = F.col(period).cast("date")
    rank = [days.isNull().alias("undated"), (-F.unix_date(days)).alias("late"), F.col(order).alias("at")]
    return _first(rows, keys, rank)


def superseded(rows: DataFrame, keys: list[str], is_latest: str, order: str) -> DataFrame:
    """One row a key (nulls are equal): the first, unless rows are marked latest; then the last of those.

    Of equals, the first by all columns in turn.
    """
    latest = F.coalesce(F.col(is_latest), F.lit(False))
    return _first(rows, keys, [(~latest).alias("old"), F.when(latest, -F.col(order)).otherwise(F.col(order)).alias("at")])


def _first(rows: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """The first row of each key by ``rank``, then by all columns."""
    least = F.min(F.struct(*rank, *[F.col(c).alias(f"c{i}") for i, c in enumerate(rows.columns)]))
    kept = rows.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(least.alias("r"))
    return kept.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(rows.columns)])


def period_days(rows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, period_days): the longest duration that isn't negative, over all rows; 0 without one."""
    days = F.datediff(end, start)
    return rows.groupBy(key).agg(F.coalesce(F.max(F.when(days >= 0, days)), F.lit(0)).alias("period_days"))
