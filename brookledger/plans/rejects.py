"""Reject records: every row Silver or Bronze turns away, with its reason."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.fixed_values import (
    BUSINESS_KEY,
    REJECT_ID_COLUMNS,
    REJECT_LISTING_ROWS,
    REJECT_PIPELINE,
    REJECT_PREFIX,
    REJECT_SEVERITY,
    REJECT_UNKNOWN_REASON,
)
from brookledger.functions.calendar import compact_stamp, moment
from brookledger.operators.dedup import superseded_rows
from brookledger.sources.tables import session_of, side_by_side

COLUMNS = [
    "reject_id", "source_table", "source_layer", "batch_id", "entity",
    "reject_reason", "reject_rule", "severity", "account_id", "transaction_id",
    "customer_id", "rejected_at", "pipeline_name",
]


def invalid_rows(silver: DataFrame, entity: str, as_of: dt.datetime) -> DataFrame:
    """The invalid Silver rows of one entity in the reject layout."""
    table = f"SILVER_{entity.upper()}"
    # A row without a business id is told apart by a hash of what it came with.
    row_hash = F.md5(F.concat_ws("|", F.lit(entity), "_batch_id", "_source_file", "dq_issues"))
    shown_id = F.coalesce(F.col(BUSINESS_KEY[entity]), F.concat(F.lit("NULL_"), row_hash))
    ids = [
        (F.col(c) if c in REJECT_ID_COLUMNS[entity] else F.lit(None).cast("string")).alias(c)
        for c in ("account_id", "transaction_id", "customer_id")
    ]
    return silver.filter(~F.col("dq_is_valid")).select(
        F.concat(F.lit(f"{REJECT_PREFIX}{compact_stamp(as_of)}_"), shown_id).alias(
            "reject_id"
        ),
        F.lit(table).alias("source_table"),
        F.lit("SILVER").alias("source_layer"),
        F.col("_batch_id").alias("batch_id"),
        F.lit(entity).alias("entity"),
        F.coalesce("dq_issues", F.lit(REJECT_UNKNOWN_REASON)).alias("reject_reason"),
        F.lit(f"DQ_{table}").alias("reject_rule"),
        F.lit(REJECT_SEVERITY[entity]).alias("severity"),
        *ids,
        moment(as_of).alias("rejected_at"),
        F.lit(REJECT_PIPELINE).alias("pipeline_name"),
    )


def all_invalid_rows(silver: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    parts = [invalid_rows(df, entity, as_of) for entity, df in silver.items()]
    return reduce(DataFrame.unionByName, parts)


def summary(rejects: DataFrame) -> DataFrame:
    return (
        rejects.groupBy("source_table", "severity")
        .agg(
            F.count(F.lit(1)).alias("reject_count"),
            F.min("rejected_at").alias("first_rejection"),
            F.max("rejected_at").alias("last_rejection"),
        )
        .orderBy("source_table", "severity")
    )


def latest(rejects: DataFrame, rows: int = REJECT_LISTING_ROWS) -> DataFrame:
    """The newest rejects; ties on time are listed by reject id."""
    return (
        rejects.select(
            "reject_id", "source_table", "source_layer", "entity", "reject_reason",
            "severity", "customer_id", "transaction_id", "rejected_at",
        )
        .orderBy(F.col("rejected_at").desc(), "reject_id", "source_table")
        .limit(rows)
    )


def duplicates(raw: DataFrame, entity: str, as_of: dt.datetime) -> DataFrame:
    """Bronze rows the dedup leaves out, so none of them vanishes silently."""
    key = BUSINESS_KEY[entity]
    return superseded_rows(raw, entity).select(
        F.lit(f"RAW_{entity.upper()}").alias("source_table"),
        F.lit(entity).alias("entity"),
        F.trim(key).alias("business_id"),
        F.col("_batch_id").alias("batch_id"),
        F.col("_load_timestamp").alias("load_timestamp"),
        F.col("_source_file").alias("source_file"),
        F.lit("DUPLICATE_KEY").alias("reason_code"),
        moment(as_of).alias("rejected_at"),
    )


def all_duplicates(raw: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    parts = side_by_side(session_of(raw), lambda e: duplicates(raw[e], e, as_of), raw)
    return reduce(DataFrame.unionByName, parts)
