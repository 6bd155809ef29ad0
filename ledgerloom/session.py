"""Spark session used by tests, benchmarks and small scripts.

On a cluster the caller passes its own session; nothing in the library builds one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution and UTC timestamps; sizes stay with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # the call site kept for every column expression slows plans of hundreds of columns
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}),
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
