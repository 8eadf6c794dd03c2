"""Session factory with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "factloom", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution on; everything else is the cluster's."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    return builder.config(map=fixed | conf).getOrCreate()
