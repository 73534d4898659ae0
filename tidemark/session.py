"""A session with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution with skew joins; anything else by ``conf`` (dots as underscores are not translated)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
