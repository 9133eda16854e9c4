"""A session with the settings that the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "leafmill", **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew handling, Arrow; ``settings`` use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
