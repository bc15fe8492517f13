"""Intermediate tables under the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from brookledger.sources.tables import new_folder


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The rows, written once and read back: cuts the lineage and outlives executors."""
    path = new_folder(df.sparkSession, f"llm-{label}")
    writer = df.write.option("compression", codec) if codec else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_exchanges(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done and no longer referred to.

    Its cleaner acts when the driver's memory is collected, which a small driver
    heap may not be for a long time, while the disks of the executors fill up.
    What Python refers to goes in the first round, what that held in the next.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
