"""Keyed merges on snapshots: upsert, insert if absent, keep newest, cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranks


def last_per_key(new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key by the given order, then by all columns in turn: one maximum a key, combined before the shuffle."""
    last = F.max(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(new.columns)]))
    kept = new.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(last.alias("r"))
    return kept.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(new.columns)])


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[k])
    return on


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``existing`` with the same key (nulls are equal) and are added otherwise.

    Applied twice it gives what it gives once.  ``order`` decides between rows of ``new`` with one key: the last counts.
    """
    new = last_per_key(new, keys, order) if order else new
    return existing.join(new, _null_safe(existing, new, keys), "left_anti").unionByName(new.select(*existing.columns))


def upsert_stable_id(existing: DataFrame, new: DataFrame, keys: list[str], id_column: str = "id") -> DataFrame:
    """As upsert, but a key keeps the id it has; new keys get ids after the largest, in key order.

    Only new keys are numbered, and their order is found by sorted ranges.
    """
    known = existing.select(*keys, id_column)
    old = new.drop(id_column).join(known, keys, "left") if id_column in new.columns else new.join(known, keys, "left")
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    fresh = old.filter(F.col(id_column).isNull()).drop(id_column)
    numbered = ranks.numbered(fresh, keys, "_n").crossJoin(F.broadcast(top)).withColumn(id_column, (F.col("_top") + F.col("_n")).cast("bigint")).drop("_top", "_n")
    changed = old.filter(F.col(id_column).isNotNull()).unionByName(numbered)
    return existing.join(changed.select(*keys), keys, "left_anti").select(*existing.columns).unionByName(changed.select(*existing.columns))


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not there yet are added, the first by all columns for each key; null keys are equal."""
    absent = new.join(existing, _null_safe(new, existing, keys), "left_anti").select(*existing.columns)
    first = F.min(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(existing.columns)]))
    kept = absent.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(first.alias("r"))
    return existing.unionByName(kept.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(existing.columns)]))


def keep_newest(rows: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """One row a key: that with the largest ``newest``, of equals the last by all columns in turn."""
    return last_per_key(rows, keys, [F.col(newest)])


def pruned_children(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children whose parent is still there."""
    return children.join(parents.select(key), key, "left_semi")


def overlay(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """Rows by key; columns of ``over`` win where they are not null."""
    a, b = base.alias("a"), over.alias("b")
    columns = [c for c in base.columns if c != key]
    return a.join(b, key, "full_outer").select(key, *[F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in columns])
