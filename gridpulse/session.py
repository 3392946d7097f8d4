"""Session settings every entry point shares."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Only settings that change results or robustness; sizing (executors, memory,
# shuffle partitions) belongs to the cluster and is passed in by the caller.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",  # the JVM's own limit: a longer method is never compiled
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "gridpulse", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
