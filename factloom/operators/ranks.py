"""Running sums, predecessors and numbers in a global order, by sorted ranges instead of one task.

Rows are dealt into sorted ranges and stored, so that a lost executor can't
move a row into another range.  Inside a range a window does the work; what
comes before a range is one row a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

_PART = "_range"


def _ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    return stored(rows.repartitionByRange(*[F.col(c) for c in order]).withColumn(_PART, F.spark_partition_id()), "ranges")


def running_total(rows: DataFrame, by: list[str], order: str, n: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``n`` over the group's rows up to this one; equal orders must not occur in a group."""
    ranged = _ranged(rows, [*by, order])
    inside = F.sum(n).over(Window.partitionBy(*by, _PART).orderBy(order))
    sums = ranged.groupBy(*by, _PART).agg(F.sum(n).alias("_sum"))
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*by, _PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    return ranged.withColumn("_inside", inside).join(before, [*by, _PART]).withColumn(name, F.col("_inside") + F.col("_before")).drop(_PART, "_inside", "_before")


def previous(rows: DataFrame, order: str, column: str, name: str, chain: str | None = None) -> DataFrame:
    """``rows`` with the value that ``column`` has in the row before, by ``order``; in a chain, if one is named."""
    by = [chain] if chain else []
    ranged = _ranged(rows, [*by, order])
    inside = Window.partitionBy(*by, _PART).orderBy(order)
    last = ranged.groupBy(*by, _PART).agg(F.max_by(F.struct(column), order).alias("_last"))
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_PART)
    before = last.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(_PART).alias("_part"), F.lag("_last").over(earlier).alias("_came"))
    same: Column = F.col(_PART) == F.col("_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    tagged = ranged.withColumn("_first", F.row_number().over(inside) == 1).withColumn("_in", F.lag(column).over(inside))
    out = tagged.join(before, same, "left").withColumn(name, F.when(F.col("_first"), F.col(f"_came.{column}")).otherwise(F.col("_in")))
    return out.select(*rows.columns, name)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with 1, 2, ... in the given order."""
    ranged = _ranged(rows, order)
    counts = ranged.groupBy(_PART).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(_PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*order))
    return ranged.withColumn("_place", place).join(before, _PART).withColumn(name, F.col("_place") + F.col("_before")).drop(_PART, "_place", "_before")
