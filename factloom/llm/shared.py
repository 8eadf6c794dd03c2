"""Shared storage for intermediate tables, and what else the operators have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..storage import drop, path, releasing, remove, root, stored

__all__ = ["drop", "own_columns", "path", "releasing", "remove", "root", "stored"]


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns that an operator reads: extra columns with clashing names can't disturb it."""
    return df.select(*[df[x] for x in names])
