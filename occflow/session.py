"""Session settings for large runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle partitions but cannot add any: set
# spark.sql.adaptive.coalescePartitions.initialPartitionNum for the largest run.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A filtering scan writes one file per task; larger splits keep them few. Small
    # inputs are still spread over all cores.
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
    # Recording the call site of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "occflow", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
