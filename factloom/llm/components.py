"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's edges: each vertex with its smallest one, at most a row per vertex."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    tied = [(x, r) for x in list(parent) if (r := find(x)) != x]
    out = np.array(tied, dtype=np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component) for every id in ``edges`` (long columns a, b), stored; component is the smallest id reachable.

    No vertex set is ever held by one task: steps are grouped minima (combined
    before the shuffle) and joins whose second side has one row per vertex, so
    adaptive execution can split a hot vertex.  An edge table without rows
    gives no rows.  Loops are ignored.
    """
    now = shared.stored(edges.select("a", "b").filter("a <> b").mapInArrow(_forest, "a long, b long"), "forest")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.withColumnRenamed("m", "b"))
        new = shared.stored(small.filter("a <> b").distinct(), "stars")
        shared.drop(now)
        now = new
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    out = now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
    out = shared.stored(out, "components")
    shared.drop(now)
    return out
