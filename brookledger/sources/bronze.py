"""CSV extracts into all-text Bronze tables.

Columns are bound by position to a declared schema. A row with too few or too
many fields is quarantined with its text instead of being dropped.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookledger.fixed_values import (
    BATCH_PREFIX,
    LANDING_MAX_MB,
    LINEAGE_COLUMNS,
    NULL_TOKENS,
    SOURCE_COLUMNS,
)
from brookledger.functions.calendar import compact_day, moment
from brookledger.sources.landing import day_parts
from brookledger.sources.tables import broadcast_if_small

BAD_RECORD = "_corrupt_record"
QUARANTINED = "_quarantined"
#: Which load of a batch id a row came with; a load's folders are written whole.
LOAD = "_load"
PARTITIONS = [QUARANTINED, "_batch_id", LOAD]
#: Names of the files that are read as CSV; others in a landing folder are left alone.
CSV_FILES = "*.csv"
_FILE = "_file"


def extract_schema(entity: str) -> T.StructType:
    names = [*SOURCE_COLUMNS[entity], BAD_RECORD]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def csv_options(*, multi_line: bool = False) -> dict[str, str]:
    """Reader options of the extract format.

    Quoted line breaks need ``multi_line``, which makes files unsplittable, so
    it is off unless asked for. Columns are never pruned while parsing: which
    rows are well formed must not depend on the columns a query selects.
    """
    return {
        "header": "true",
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_RECORD,
        "enforceSchema": "true",
        "columnPruning": "false",
        "multiLine": str(multi_line).lower(),
    }


def read_extract(
    spark: SparkSession,
    path: str,
    entity: str,
    *,
    day: dt.date | None = None,
    multi_line: bool = False,
    max_mb: int = LANDING_MAX_MB,
) -> DataFrame:
    """Parsed rows of an entity's landing folder, or of one landing day.

    For a day only its own folder is listed and read. Only eligible files are:
    those of another type, or above ``max_mb``, are dropped from the listing
    and never opened; ``landing.eligibility`` lists them with the reason.
    """
    reader = (
        spark.read.schema(extract_schema(entity))
        .options(**csv_options(multi_line=multi_line))
        .option("basePath", path)
        .option("pathGlobFilter", CSV_FILES)
    )
    found = reader.csv(path if day is None else posixpath.join(path, day_parts(day)))
    return found.filter(small_enough(max_mb))


def small_enough(max_mb: int) -> Column:
    """Whether a row's file is within the size limit; known from the listing."""
    return F.col("_metadata.file_size") <= max_mb * 1024 * 1024


def _null_tokens_out(name: str) -> Column:
    return F.when(~F.col(name).isin(NULL_TOKENS), F.col(name)).alias(name)


def to_bronze(parsed: DataFrame, entity: str, as_of: dt.datetime, file: str = "_metadata.file_path") -> DataFrame:
    """Source columns as text, lineage, and whether the row is quarantined.

    ``file`` names the column with the file a row came from.
    """
    return parsed.select(
        *[_null_tokens_out(c) for c in SOURCE_COLUMNS[entity]],
        F.col(file).alias("_source_file"),
        F.lit(entity).alias("_source_entity"),
        moment(as_of).alias("_load_timestamp"),
        F.lit(f"{BATCH_PREFIX}{compact_day(as_of)}").alias("_batch_id"),
        F.lit(None).cast("string").alias("_checksum"),
        F.col(BAD_RECORD),
        F.col(BAD_RECORD).isNotNull().alias(QUARANTINED),
    )


def with_checksums(bronze: DataFrame, manifest: DataFrame, *, max_files: int = 1_000_000) -> DataFrame:
    """Fill ``_checksum`` from a landing manifest (path, checksum_md5).

    The manifest has one short row per file; it is broadcast only if counted
    to be small, and joined by path otherwise.
    """
    sums = manifest.select(F.col("path").alias(_FILE), "checksum_md5")
    joined = bronze.join(
        broadcast_if_small(sums, max_files), F.col("_source_file") == F.col(_FILE), "left"
    )
    return joined.withColumn("_checksum", F.col("checksum_md5")).select(*bronze.columns)


def store(bronze: DataFrame, path: str) -> None:
    """Append a load, whole and quarantined rows apart, from one parse.

    Each batch has folders of its own, so later jobs can read it alone. The
    table may be one that incremental loads append to.
    """
    store_load(bronze, path, f"forced-{uuid.uuid4().hex[:12]}")


def store_load(bronze: DataFrame, path: str, load: str) -> None:
    """Write the folders of one named load; what an earlier try left there is replaced."""
    (
        bronze.withColumn(LOAD, F.lit(load))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def table_schema(entity: str) -> T.StructType:
    """Columns of a stored Bronze table."""
    fields = [T.StructField(n, T.StringType()) for n in SOURCE_COLUMNS[entity]]
    for name in LINEAGE_COLUMNS:
        kind = T.TimestampNTZType() if name == "_load_timestamp" else T.StringType()
        fields.append(T.StructField(name, kind))
    fields.append(T.StructField(BAD_RECORD, T.StringType()))
    fields.append(T.StructField(QUARANTINED, T.BooleanType()))
    return T.StructType([*fields, T.StructField(LOAD, T.StringType())])


def rows(
    spark: SparkSession, path: str, entity: str, *, batch_id: str | None = None
) -> DataFrame:
    """The well-formed rows of a stored Bronze table, or of one of its batches."""
    stored = spark.read.schema(table_schema(entity)).parquet(path)
    if batch_id is not None:
        stored = stored.filter(F.col("_batch_id") == batch_id)
    return stored.filter(~F.col(QUARANTINED)).select(
        *SOURCE_COLUMNS[entity], *LINEAGE_COLUMNS
    )


def quarantine(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The malformed rows, as the text that was read."""
    stored = spark.read.schema(table_schema(entity)).parquet(path)
    return stored.filter(F.col(QUARANTINED)).select(
        F.col(BAD_RECORD).alias("record"), "_source_file", "_source_entity", "_batch_id"
    )
