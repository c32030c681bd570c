"""Spark session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does three jobs here: it coalesces small shuffle partitions, splits the
# shuffle partitions of hot keys in joins, and turns a join into a broadcast
# join once the real size of a side is known to be below the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "lumitrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` keys use `_` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
