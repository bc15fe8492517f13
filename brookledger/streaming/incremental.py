"""Load each landed file exactly once.

The file source remembers in its checkpoint which files it has handled, so a
run takes what has arrived since the last one and then stops. How old a file
is makes no difference: back-fills that keep their times are loaded too.

Each micro-batch goes into folders of its own in a plain partitioned table,
which batch loads (``bronze.store``) append to as well. A micro-batch that is
retried writes the same folders again.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession

from brookledger.fixed_values import LANDING_MAX_MB
from brookledger.sources.bronze import (
    CSV_FILES,
    csv_options,
    extract_schema,
    small_enough,
    store_load,
    to_bronze,
)

#: Longer than any back-fill: the source forgets no file because of its age.
_ANY_AGE = "36500d"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    entity: str,
    target: str,
    checkpoint: str,
    as_of: dt.datetime,
    *,
    files_per_trigger: int = 1000,
    max_mb: int = LANDING_MAX_MB,
) -> None:
    """Append the rows of eligible files not seen before, then return.

    ``files_per_trigger`` bounds one micro-batch, so a backlog is worked off
    in steps that each commit. Files of another type or above ``max_mb`` are
    not loaded; ``landing.eligibility`` lists them with the reason.
    """
    arrived = (
        spark.readStream.schema(extract_schema(entity))
        .options(**csv_options())
        .option("pathGlobFilter", CSV_FILES)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("maxFileAge", _ANY_AGE)
        .csv(source)
        .filter(small_enough(max_mb))
    )
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def append(batch: DataFrame, number: int) -> None:
        store_load(batch, target, f"{stream}-{number}")

    run = (
        to_bronze(arrived, entity, as_of)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
