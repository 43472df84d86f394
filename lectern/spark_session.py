"""A session with the settings that the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """Adaptive execution with skew handling, and UTC; other settings are the cluster's."""
    builder = SparkSession.builder.appName("lectern").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return (builder.master(master) if master else builder).getOrCreate()
