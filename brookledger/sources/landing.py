"""The landing zone: dated folders of extract files, their manifest and checks.

Files are handled as rows of a listing, so any number of them is checked,
hashed and reconciled by executors, not by a loop on the driver.
"""

from __future__ import annotations

import datetime as dt
import math
import posixpath
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import (
    ENTITIES,
    LANDING_EXTENSIONS,
    LANDING_MAX_MB,
    SOURCE_COLUMNS,
)
from brookledger.functions.calendar import moment

BYTES_PER_MB = 1024 * 1024
_ENTITY_IN_PATH = r"/raw/([^/]+)/year="


def entity_folder(root: str, entity: str) -> str:
    return posixpath.join(root, "raw", entity)


def day_parts(day: dt.date) -> str:
    """Dated part of a landing path; month and day have two digits."""
    return posixpath.join(f"year={day:%Y}", f"month={day:%m}", f"day={day:%d}")


def day_folder(root: str, entity: str, day: dt.date) -> str:
    return posixpath.join(entity_folder(root, entity), day_parts(day))


def _dated(df: DataFrame, entity: str, day: dt.date) -> DataFrame:
    return df.select(
        *SOURCE_COLUMNS[entity],
        F.lit(f"{day:%Y}").alias("year"),
        F.lit(f"{day:%m}").alias("month"),
        F.lit(f"{day:%d}").alias("day"),
    )


def csv_bytes(df: DataFrame) -> int:
    """Bytes that the rows take as CSV at most, without headers: quoted fields, quotes doubled, separators."""

    def field(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return 2 * F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit(""))) + 3

    return df.agg(F.sum(sum(map(field, df.columns), F.lit(0)).cast("long"))).first()[0] or 0


def in_files(df: DataFrame, *, file_mb: float, at_least: int = 2) -> DataFrame:
    """The rows dealt evenly to as many partitions, so files, as keep each at about ``file_mb`` megabytes or less.

    ``df`` is read twice, first for its size.
    """
    return df.repartition(max(at_least, math.ceil(csv_bytes(df) / (file_mb * BYTES_PER_MB))))


def land_csv(df: DataFrame, root: str, entity: str, day: dt.date) -> None:
    """Write source rows as CSV files of one landing day. Blanks are kept."""
    (
        _dated(df, entity, day)
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .options(
            header="true",
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
        .csv(entity_folder(root, entity))
    )


def land_json(df: DataFrame, root: str, entity: str, day: dt.date) -> None:
    """Write source rows as JSON lines; missing values stay as null fields."""
    (
        _dated(df, entity, day)
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .option("ignoreNullFields", "false")
        .json(entity_folder(root, entity))
    )


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, entity, length, modificationTime) of the landed files.

    File contents are not read.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    return files.select(
        "path",
        F.regexp_extract("path", _ENTITY_IN_PATH, 1).alias("entity"),
        "length",
        "modificationTime",
    )


def eligibility(files: DataFrame, *, max_mb: float = LANDING_MAX_MB) -> DataFrame:
    """Whether each file may be loaded, and why not.

    ``max_mb`` is the largest size of a file, in megabytes of 1024 * 1024 bytes.
    """
    extension = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    reason = F.when(~extension.isin(LANDING_EXTENSIONS), "Invalid file type").when(
        F.col("length") > max_mb * BYTES_PER_MB, "File too large"
    )
    return files.select(
        "path", "entity", "length", reason.isNull().alias("is_valid"), reason.alias("reason")
    )


def manifest(
    spark: SparkSession, root: str, as_of: dt.datetime, *, max_mb: float = LANDING_MAX_MB
) -> DataFrame:
    """MD5 and size of each file that may be loaded; others are listed as FAILED.

    Only files within the size limit (``max_mb``) are opened, so no task holds
    more than one file of that size.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    limit = max_mb * BYTES_PER_MB
    allowed = F.regexp_extract("path", r"(\.[^./]+)$", 1).isin(LANDING_EXTENSIONS)
    entity = F.regexp_extract("path", _ENTITY_IN_PATH, 1).alias("entity")
    hashed = files.filter((F.col("length") <= limit) & allowed).select(
        "path", entity, "length", F.md5("content").alias("checksum_md5"),
        F.lit("SUCCESS").alias("status"),
    )
    refused = files.filter((F.col("length") > limit) | ~allowed).select(
        "path", entity, "length", F.lit(None).cast("string").alias("checksum_md5"),
        F.lit("FAILED").alias("status"),
    )
    return hashed.unionByName(refused).withColumn("uploaded_at", moment(as_of))


def manifest_totals(manifest_rows: DataFrame) -> DataFrame:
    return manifest_rows.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum("length").alias("total_bytes"),
    )


def reconcile(promised: DataFrame, found: DataFrame) -> DataFrame:
    """Compare a manifest with the files there now.

    A promised file is OK, CHANGED (other checksum) or MISSING; a file nobody
    promised is UNEXPECTED.
    """
    mine = promised.select("path", "entity", F.col("checksum_md5").alias("promised_md5"))
    theirs = found.select(
        "path", F.col("entity").alias("found_entity"), F.col("checksum_md5").alias("found_md5"),
        F.lit(True).alias("is_there"),
    )
    state = (
        F.when(F.col("is_there").isNull(), "MISSING")
        .when(F.col("entity").isNull(), "UNEXPECTED")
        .when(F.col("promised_md5").eqNullSafe(F.col("found_md5")), "OK")
        .otherwise("CHANGED")
    )
    return mine.join(theirs, "path", "full").select(
        "path", F.coalesce("entity", "found_entity").alias("entity"), state.alias("state")
    )


def missing_entities(files: DataFrame, expected: Sequence[str] = tuple(ENTITIES)) -> DataFrame:
    """Entities of which no file has arrived."""
    wanted = files.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(e) for e in expected])).alias("entity")
    )
    return wanted.join(files.select("entity").distinct(), "entity", "left_anti")
