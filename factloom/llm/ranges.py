"""Ranges of doc_id that hold about equally many rows, fixed by stated cut points.

Cut points come from a mergeable quantile sketch over the id column alone, so
a retried task finds the same ranges as the lost one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_A_RANGE = 4096
MOST_RANGES = 20_000


def cut_points(docs: DataFrame, per: int = ROWS_A_RANGE) -> list[int]:
    """Ascending ids; range r holds the ids from cut r-1 (included) up to cut r.  At most MOST_RANGES numbers."""
    rows = docs.agg(F.count("doc_id")).first()[0]
    n = int(min(MOST_RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per))))
    if rows == 0 or n < 2:
        return []
    got = docs.agg(F.percentile_approx("doc_id", [float(x) for x in np.arange(1, n) / n], max(10_000, 4 * n))).first()[0]
    return sorted({int(x) for x in got})


def range_of(column: str, cuts: list[int]) -> Column:
    """Index of an id's range; a null id is in the first, with the smallest ids.  Only the id goes to Python."""
    held = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def find(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(held, ids.to_numpy(np.int64), "right").astype(np.int32))

    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(find(F.coalesce(F.col(column), F.lit(0)).cast("long")))


def dealt(df: DataFrame, cuts: list[int]) -> DataFrame:
    """Range r in partition r."""
    return df.repartitionById(len(cuts) + 1, F.col("range"))


def ringed(docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """((doc_id, text, range, ghost), cut points): each range of ids, closed by ghosts of the first row of the next one.

    Rows count downwards, so the next range is the one below; the last range is
    closed by the first of all.
    """
    cuts = cut_points(docs.select("doc_id"))
    placed = docs.withColumn("range", range_of("doc_id", cuts))
    tops = {r["range"]: r["top"] for r in placed.groupBy("range").agg(F.max("doc_id").alias("top")).collect()}
    down = sorted(tops, reverse=True)
    if not down:
        return placed.withColumn("ghost", F.lit(False)), cuts
    # The top row of a range closes the range above it; that of the first range closes the last.
    closes = docs.sparkSession.createDataFrame([(r, tops[r], down[i - 1]) for i, r in enumerate(down)], "own int, top long, above int")
    whole = docs.join(F.broadcast(closes), F.col("doc_id").eqNullSafe(F.col("top"))).select("doc_id", "text", F.col("above").alias("range"), F.lit(True).alias("ghost"))
    return placed.withColumn("ghost", F.lit(False)).unionByName(whole), cuts
