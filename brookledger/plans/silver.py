"""Bronze to Silver: newest row per key, cleaned, typed, checked.

Each job costs one shuffle (the dedup). Everything after it is one generated
projection: text is parsed once, and derived columns read the parsed values.
Invalid rows stay in Silver with a reason, so rejects can be read from it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookledger.fixed_values import (
    CREDIT_TIERS_AT_LEAST,
    REQUIRED_IN_SILVER,
    SEVERITY_RANK,
)
from brookledger.functions.bands import band_at_least, is_true, value_map
from brookledger.functions.calendar import (
    date_key,
    day,
    days_crossed,
    moment,
    years_crossed,
)
from brookledger.functions.casts import (
    iso_date,
    iso_timestamp,
    money,
    ratio,
    text,
    title,
    whole_number,
)
from brookledger.operators.dedup import latest_per_key

_LINEAGE = ["_source_file", "_batch_id"]


def _validity(entity: str) -> dict[str, Column]:
    rules = REQUIRED_IN_SILVER[entity]
    first_issue = F.coalesce(
        *[F.when(F.col(name).isNull(), F.lit(issue)) for name, issue in rules]
    )
    return {"dq_issues": first_issue, "dq_is_valid": first_issue.isNull()}


def _upper(name: str) -> Column:
    return F.upper(text(name))


def _customers(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    today = day(as_of)
    parsed = rows.select(
        text("customer_id").alias("customer_id"),
        title("first_name").alias("first_name"),
        title("last_name").alias("last_name"),
        F.lower(text("email")).alias("email"),
        *[text(c).alias(c) for c in ("phone", "address_line1", "address_line2", "zip_code")],
        title("city").alias("city"),
        *[_upper(c).alias(c) for c in ("state", "country", "status")],
        *[iso_date(c).alias(c) for c in ("date_of_birth", "customer_since")],
        whole_number("credit_score").alias("score"),
        *[iso_timestamp(c).alias(c) for c in ("created_at", "updated_at")],
        *_LINEAGE,
    )
    return parsed.select(
        "customer_id", "first_name", "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", "phone", "date_of_birth",
        years_crossed(F.col("date_of_birth"), today).alias("age_years"),
        "address_line1", "address_line2", "city", "state", "zip_code", "country",
        "customer_since",
        days_crossed(F.col("customer_since"), today).alias("tenure_days"),
        "status",
        F.col("score").try_cast("int").alias("credit_score"),
        band_at_least(F.col("score"), CREDIT_TIERS_AT_LEAST).alias("credit_tier"),
        "created_at", "updated_at", *_LINEAGE,
    )


def _accounts(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    parsed = rows.select(
        *[text(c).alias(c) for c in ("account_id", "customer_id", "account_number", "branch_code")],
        *[_upper(c).alias(c) for c in ("account_type", "currency", "status")],
        *[money(c).alias(c) for c in ("balance", "available_balance")],
        ratio("interest_rate").alias("interest_rate"),
        iso_date("opened_date").alias("opened_date"),
        *[iso_timestamp(c).alias(c) for c in ("created_at", "updated_at")],
        *_LINEAGE,
    )
    return parsed.select(
        "account_id", "customer_id", "account_number", "account_type",
        "balance", "available_balance", "currency", "interest_rate", "opened_date",
        days_crossed(F.col("opened_date"), day(as_of)).alias("account_age_days"),
        "status", "branch_code",
        is_true(F.col("balance") < 0).alias("is_overdrawn"),
        "created_at", "updated_at", *_LINEAGE,
    )


def _transactions(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    parsed = rows.select(
        *[
            text(c).alias(c)
            for c in ("transaction_id", "account_id", "customer_id", "description",
                      "reference_number")
        ],
        *[
            _upper(c).alias(c)
            for c in ("transaction_type", "currency", "merchant_category", "channel",
                      "status")
        ],
        title("merchant_name").alias("merchant_name"),
        *[money(c).alias(c) for c in ("amount", "balance_after")],
        *[iso_timestamp(c).alias(c) for c in ("transaction_date", "created_at")],
        iso_date("transaction_date").alias("on_day"),
        iso_date("value_date").alias("value_date"),
        *_LINEAGE,
    )
    return parsed.select(
        "transaction_id", "account_id", "customer_id", "transaction_type", "amount",
        F.abs("amount").alias("amount_abs"),
        is_true(F.col("amount") < 0).alias("is_debit"),
        is_true(F.col("amount") > 0).alias("is_credit"),
        "currency", "balance_after", "description", "merchant_name",
        "merchant_category", "channel", "status", "transaction_date",
        date_key(F.col("on_day")).alias("transaction_date_key"),
        "value_date", "reference_number", "created_at", *_LINEAGE,
    )


def _fraud_flags(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    parsed = rows.select(
        *[
            text(c).alias(c)
            for c in ("flag_id", "transaction_id", "account_id", "customer_id",
                      "flag_reason", "reviewed_by")
        ],
        _upper("severity").alias("severity"),
        ratio("fraud_score").alias("fraud_score"),
        is_true(_upper("is_confirmed_fraud") == "TRUE").alias("is_confirmed_fraud"),
        *[iso_timestamp(c).alias(c) for c in ("flagged_at", "reviewed_at", "created_at")],
        *_LINEAGE,
    )
    until = F.coalesce(F.col("reviewed_at"), moment(as_of))
    return parsed.select(
        "flag_id", "transaction_id", "account_id", "customer_id", "flag_reason",
        "severity",
        value_map(F.col("severity"), SEVERITY_RANK, 0).alias("severity_rank"),
        "fraud_score", "is_confirmed_fraud", "flagged_at", "reviewed_at", "reviewed_by",
        days_crossed(F.col("flagged_at"), until).alias("days_to_review"),
        "created_at", *_LINEAGE,
    )


_CLEANERS: dict[str, Callable[[DataFrame, dt.datetime], DataFrame]] = {
    "customers": _customers,
    "accounts": _accounts,
    "transactions": _transactions,
    "fraud_flags": _fraud_flags,
}


def to_silver(
    raw: DataFrame,
    entity: str,
    as_of: dt.datetime,
    *,
    normalize_key: bool = False,
) -> DataFrame:
    """The Silver table of one entity from all its Bronze rows."""
    newest = latest_per_key(raw, entity, normalize_key=normalize_key)
    return clean_silver(newest, entity, as_of)


def clean_silver(newest: DataFrame, entity: str, as_of: dt.datetime) -> DataFrame:
    """Silver rows from Bronze rows that hold each key once; no shuffle."""
    clean = _CLEANERS[entity](newest, as_of)
    verdict = _validity(entity)
    return clean.select(
        *[c for c in clean.columns if c not in _LINEAGE],
        verdict["dq_is_valid"].alias("dq_is_valid"),
        verdict["dq_issues"].alias("dq_issues"),
        *_LINEAGE,
        moment(as_of).alias("_silver_loaded_at"),
    )
