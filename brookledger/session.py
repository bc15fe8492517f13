"""A Spark session with the settings these jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan joins from measured sizes, merge small shuffle partitions and
    # split hot ones: the fact joins rely on this for skewed accounts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that lie by key bucket can be joined on (bucket, id) where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Call sites of every column expression are only worth their cost in debugging.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "brookledger", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
