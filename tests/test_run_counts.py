"""Run-log counts come from the jobs that write, not from a further scan."""

from __future__ import annotations

import datetime as dt

from conftest import plan_of
from pyspark.sql import functions as F

from brookledger.plans import audit
from brookledger.sources.tables import write_tables

DAY = dt.datetime(2024, 3, 1)


def test_counts_are_those_of_the_written_rows(spark, tmp_path):
    loads = audit.Loads()
    rows = spark.range(0, 1_000, numPartitions=7).withColumn("ok", F.col("id") % 10 != 0)
    write_tables(
        {
            "some": loads.watched(rows.groupBy("id", "ok").count(), "some", F.col("ok")),
            "all": loads.watched(rows, "all"),
            "none": loads.watched(rows.limit(0), "none", F.col("ok")),
        },
        str(tmp_path),
    )
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    log = loads.log_rows(spark, ["some", "all", "none"], "SILVER", "bronze_to_silver", DAY)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == jobs
    assert "parquet" not in plan_of(log).lower()
    got = {r.entity: (r.records_read, r.records_loaded, r.records_failed) for r in log.collect()}
    assert got == {"some": (1000, 900, 100), "all": (1000, 1000, 0), "none": (0, 0, 0)}
