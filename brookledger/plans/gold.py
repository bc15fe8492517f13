"""Silver to Gold: date, customer and account dimensions and two facts.

Surrogate keys number the rows of stored Silver tables; see
``operators.keys``. Facts are numbered before their lookups, and each lookup
joins the narrow (business id, key) pair of a dimension, so the wide side is
never aggregated. Accounts and customers grow with the data and are joined
without a broadcast hint: Spark picks the strategy from measured sizes and
splits the partitions of hot accounts. Only the calendar, whose size is
fixed, is broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import (
    ACCOUNT_TYPE_DESCRIPTION,
    ACCOUNT_TYPE_OTHER,
    ACTIVE,
    AGE_BANDS_BELOW,
    CALENDAR_DAYS,
    CALENDAR_START,
    DURATION_BANDS_BELOW,
    FRAUD_BANDS_AT_LEAST,
    REVIEW_SLA_DAYS,
)
from brookledger.functions.bands import band_at_least, band_below, is_true, value_map
from brookledger.functions.calendar import date_key, moment
from brookledger.operators.keys import BUCKET, with_bucket, with_dense_key, with_lasting_key
from brookledger.operators.sieve import may_match


def valid_rows(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("dq_is_valid"))


def dim_date(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    """One row per day of the fixed calendar; weeks start on Sunday as 0."""
    d = F.col("full_date")
    weekday = F.dayofweek(d) - 1
    weekend = weekday.isin(0, 6)
    last_of_quarter = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    days = spark.range(CALENDAR_DAYS).select(
        F.date_add(F.lit(CALENDAR_START), F.col("id").cast("int")).alias("full_date")
    )
    return days.select(
        date_key(d).alias("date_key"),
        d,
        weekday.alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.left(F.monthname(d), F.lit(3)).alias("month_short"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year_number"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == F.trunc(d, "quarter")).alias("is_quarter_start"),
        (d == last_of_quarter).alias("is_quarter_end"),
        moment(as_of).alias("_gold_loaded_at"),
    )


def customer_attributes(silver_customers: DataFrame) -> DataFrame:
    """The dimension's columns for every valid customer, without its key."""
    return valid_rows(silver_customers).select(
        "customer_id", "first_name", "last_name", "full_name", "email", "city", "state",
        "country", "customer_since", "tenure_days",
        band_below(F.col("tenure_days"), DURATION_BANDS_BELOW).alias("tenure_band"),
        "age_years",
        band_below(F.col("age_years"), AGE_BANDS_BELOW).alias("age_band"),
        "status", "credit_score", "credit_tier",
        is_true(F.col("status") == ACTIVE).alias("is_active"),
        "_silver_loaded_at",
    )


def _keyed(
    rows: DataFrame, key: str, id_name: str, known: DataFrame | None, tie_break: list[Column],
    last_key: int | None = None,
) -> DataFrame:
    """Keys from 1 on for a first load; later loads pass the table before as ``known``."""
    if known is None:
        return with_dense_key(rows, key, id_name, tie_break=tie_break)
    return with_lasting_key(rows, key, id_name, known, tie_break=tie_break, last_key=last_key)


def dim_customers(
    silver_customers: DataFrame, as_of: dt.datetime, known: DataFrame | None = None
) -> DataFrame:
    keyed = _keyed(
        customer_attributes(silver_customers), "customer_key", "customer_id", known,
        [F.col("email"), F.col("full_name")],
    )
    return keyed.withColumn("_gold_loaded_at", moment(as_of))


def dim_accounts(
    silver_accounts: DataFrame, as_of: dt.datetime, known: DataFrame | None = None
) -> DataFrame:
    rows = valid_rows(silver_accounts).select(
        "account_id", "customer_id", "account_number", "account_type",
        value_map(
            F.col("account_type"), ACCOUNT_TYPE_DESCRIPTION, ACCOUNT_TYPE_OTHER
        ).alias("account_type_desc"),
        "currency", "interest_rate", "opened_date", "account_age_days",
        band_below(F.col("account_age_days"), DURATION_BANDS_BELOW).alias(
            "account_age_band"
        ),
        "status", "branch_code", "is_overdrawn",
        is_true(F.col("status") == ACTIVE).alias("is_active"),
        "_silver_loaded_at",
    )
    keyed = _keyed(
        rows, "account_key", "account_id", known,
        [F.col("customer_id"), F.col("account_number")],
    )
    return keyed.withColumn("_gold_loaded_at", moment(as_of))


def current_rows(dim: DataFrame) -> DataFrame:
    """The live version of each member, for dimensions that keep history."""
    return dim.filter(F.col("is_current")) if "is_current" in dim.columns else dim


def with_dimension_keys(
    fact: DataFrame, accounts: DataFrame, customers: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Add account_key, customer_key and date_key; no match leaves NULL.

    ``fact`` brings account_id, customer_id and an int column ``_on_day``.
    """
    account_keys = accounts.select("account_id", "account_key")
    customer_keys = current_rows(customers).select("customer_id", "customer_key")
    days = calendar.select("date_key")
    return (
        fact.join(F.broadcast(days), F.col("_on_day") == F.col("date_key"), "left")
        .join(account_keys, "account_id", "left")
        .join(customer_keys, "customer_id", "left")
        .drop("_on_day")
    )


def transaction_keys(silver_transactions: DataFrame) -> DataFrame:
    """(transaction_id, transaction_key), the same keys the fact carries."""
    ids = valid_rows(silver_transactions).select("transaction_id", "reference_number")
    return _number_transactions(ids).select("transaction_id", "transaction_key")


def _number_transactions(rows: DataFrame, *, keep_bucket: bool = False) -> DataFrame:
    return with_dense_key(
        rows,
        "transaction_key",
        "transaction_id",
        tie_break=[F.col("reference_number")],
        keep_bucket=keep_bucket,
    )


def fact_transactions(
    silver_transactions: DataFrame,
    silver_fraud_flags: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    calendar: DataFrame,
    as_of: dt.datetime,
    known: DataFrame | None = None,
    last_key: int | None = None,
) -> DataFrame:
    """The transaction fact; rows of ``known`` (the fact before) keep their keys.

    ``last_key`` is the largest key so far where ``known`` is a part of the fact.

    A first load moves the wide rows three times: by key bucket, where they are
    numbered and meet the flags, by account and by customer.
    """
    rows = valid_rows(silver_transactions).select(
        "transaction_id", "account_id", "customer_id", "transaction_type", "amount",
        "amount_abs", "is_debit", "is_credit", "currency", "balance_after",
        "merchant_name", "merchant_category", "channel", "status", "transaction_date",
        "value_date", "reference_number",
        F.col("transaction_date_key").alias("_on_day"),
    )
    # One row per flagged transaction, so the join cannot repeat a fact row.
    flagged = (
        valid_rows(silver_fraud_flags)
        .select("transaction_id")
        .distinct()
        .withColumn("_flagged", F.lit(True))
    )
    if known is None:
        on = [BUCKET, "transaction_id"]
        numbered = _number_transactions(rows, keep_bucket=True).join(
            with_bucket(flagged, "transaction_id"), on, "left"
        )
    else:
        numbered = with_lasting_key(
            rows, "transaction_key", "transaction_id", known,
            tie_break=[F.col("reference_number")], last_key=last_key,
        ).join(flagged, "transaction_id", "left")
    joined = with_dimension_keys(numbered, accounts, customers, calendar)
    return joined.select(
        "transaction_key", "transaction_id", "account_key", "customer_key", "date_key",
        "account_id", "customer_id", "transaction_type", "amount", "amount_abs",
        "is_debit", "is_credit", "currency", "balance_after", "merchant_name",
        "merchant_category", "channel", "status", "transaction_date", "value_date",
        "reference_number",
        is_true(F.col("_flagged")).alias("is_fraud_flagged"),
        moment(as_of).alias("_gold_loaded_at"),
    )


def fact_fraud(
    silver_fraud_flags: DataFrame,
    keyed_transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    calendar: DataFrame,
    as_of: dt.datetime,
    known: DataFrame | None = None,
    last_key: int | None = None,
) -> DataFrame:
    """``keyed_transactions``: the transaction fact, or its id and key alone.

    Transactions that no flag can name are left out by a Bloom filter before
    their exchange. The flags are counted: pass a stored table.
    """
    rows = valid_rows(silver_fraud_flags).select(
        "flag_id", "transaction_id", "account_id", "customer_id", "flag_reason",
        "severity", "severity_rank", "fraud_score", "is_confirmed_fraud", "flagged_at",
        "reviewed_at", "days_to_review",
        date_key(F.to_date("flagged_at")).alias("_on_day"),
    )
    numbered = _keyed(rows, "fraud_key", "flag_id", known, [F.col("transaction_id")], last_key)
    keys = may_match(
        keyed_transactions.select("transaction_id", "transaction_key"), "transaction_id",
        valid_rows(silver_fraud_flags), "transaction_id",
    )
    joined = with_dimension_keys(numbered, accounts, customers, calendar).join(
        keys, "transaction_id", "left"
    )
    return joined.select(
        "fraud_key", "flag_id", "transaction_key", "account_key", "customer_key",
        "date_key", "transaction_id", "account_id", "customer_id", "flag_reason",
        "severity", "severity_rank", "fraud_score",
        band_at_least(F.col("fraud_score"), FRAUD_BANDS_AT_LEAST).alias(
            "fraud_score_band"
        ),
        "is_confirmed_fraud", "flagged_at", "reviewed_at", "days_to_review",
        is_true(F.col("days_to_review") <= REVIEW_SLA_DAYS).alias("review_sla_met"),
        moment(as_of).alias("_gold_loaded_at"),
    )
