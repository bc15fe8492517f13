"""The run log: one row per job run."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookledger.functions.calendar import moment

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("entity", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("records_read", T.LongType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType(), False),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("s3_source_path", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)


def run_row(
    counts: DataFrame,
    *,
    run_id: str,
    pipeline: str,
    entity: str,
    started_at: dt.datetime,
    completed_at: dt.datetime | None = None,
    status: str = "SUCCESS",
    read: Column | None = None,
    loaded: Column | None = None,
    failed: Column | None = None,
    error: str | None = None,
    source_path: str | None = None,
) -> DataFrame:
    """A log row per row of ``counts``; counts not given are 0."""
    zero = F.lit(0)
    values = {
        "run_id": F.lit(run_id),
        "pipeline_name": F.lit(pipeline),
        "entity": F.lit(entity),
        "status": F.lit(status),
        "records_read": zero if read is None else read,
        "records_loaded": zero if loaded is None else loaded,
        "records_failed": zero if failed is None else failed,
        "started_at": moment(started_at),
        "completed_at": moment(completed_at or started_at),
        "error_message": F.lit(error),
        "s3_source_path": F.lit(source_path),
        "created_at": moment(completed_at or started_at),
    }
    return counts.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA.fields]
    )


def silver_load_row(silver: DataFrame, entity: str, as_of: dt.datetime) -> DataFrame:
    """Log row of a Silver load: rows read are valid plus failed ones."""
    counts = silver.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("dq_is_valid")).alias("valid")
    )
    return run_row(
        counts,
        run_id=f"SILVER_{entity.upper()}_{as_of:%Y%m%d_%H%M%S}",
        pipeline="bronze_to_silver",
        entity=entity,
        started_at=as_of,
        read=F.col("n"),
        loaded=F.col("valid"),
        failed=F.col("n") - F.col("valid"),
    )


def silver_load_rows(silver: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    rows = [silver_load_row(df, entity, as_of) for entity, df in silver.items()]
    return reduce(DataFrame.unionByName, rows)


class Loads:
    """Counts of loads, observed by the jobs that write them.

    ``watched`` goes around the rows that a job writes, as the last step before
    the write, whose tasks count each row once however often they are redone.
    The log rows then come without a look at the stored table.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watched(self, df: DataFrame, name: str, valid: Column | None = None) -> DataFrame:
        """The rows unchanged; all are read, and loaded are those that are ``valid`` (all, if not said)."""
        self._seen[name] = Observation(f"load-{name}")
        loaded = F.count(F.lit(1)) if valid is None else F.count_if(valid)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("read"), loaded.alias("loaded"))

    def log_rows(self, spark: SparkSession, names: Iterable[str], layer: str, pipeline: str, as_of: dt.datetime) -> DataFrame:
        """A SUCCESS row for each of these loads; their writes must have ended."""
        frames = []
        for name in names:
            seen = self._seen[name].get
            read, loaded = F.lit(seen["read"]), F.lit(seen["loaded"])
            frames.append(run_row(
                spark.range(1), run_id=f"{layer}_{name.upper()}_{as_of:%Y%m%d_%H%M%S}", pipeline=pipeline,
                entity=name, started_at=as_of, read=read, loaded=loaded, failed=read - loaded))
        return reduce(DataFrame.unionByName, frames)


def append(log_rows: DataFrame, path: str) -> None:
    log_rows.write.mode("append").parquet(path)


@contextlib.contextmanager
def failure_logged(
    spark: SparkSession, path: str, *, run_id: str, pipeline: str, entity: str, as_of: dt.datetime
) -> Iterator[None]:
    """Append a FAILED row with the message if the block raises, and raise on."""
    try:
        yield
    except Exception as error:
        append(
            run_row(
                spark.range(1), run_id=run_id, pipeline=pipeline, entity=entity,
                started_at=as_of, status="FAILED", error=str(error),
            ),
            path,
        )
        raise
