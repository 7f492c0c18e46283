"""Spark session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins carry no broadcast hints for tables that can grow: Spark compares the
# planned size with autoBroadcastJoinThreshold, and AQE compares the measured
# size again after the shuffle. Beyond it, a sort-merge join runs and AQE splits
# hot keys, also where that costs the parent one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "shelflens", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` takes dotted names as a dict."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
