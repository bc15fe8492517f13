"""Row counts and load profiles of each layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one counted row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def valid_counts(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and valid rows per Silver table, from one pass each."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("dq_is_valid")).alias("valid_count"),
        ).select(F.lit(name).alias("table_name"), "row_count", "valid_count")
        for name, df in silver.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def batches(raw: DataFrame) -> DataFrame:
    """What each batch loaded, newest first."""
    return (
        raw.groupBy("_batch_id", "_source_entity")
        .agg(
            F.count(F.lit(1)).alias("records_loaded"),
            F.min("_load_timestamp").alias("load_started"),
            F.max("_load_timestamp").alias("load_completed"),
        )
        .orderBy(F.col("load_started").desc(), "_batch_id")
    )


def null_profile(raw_customers: DataFrame) -> DataFrame:
    """Missing critical values of a customer load in one pass."""
    names = {
        "customer_id": "null_customer_ids",
        "email": "null_emails",
        "status": "null_statuses",
    }
    return raw_customers.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(alias) for c, alias in names.items()],
    )


def sample(raw: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """A few rows to look at; sorted by every column, so always the same ones."""
    rest = [c for c in raw.columns if c != key]
    return raw.orderBy(F.col(key).asc_nulls_last(), *rest).limit(rows)
