"""Reports over the star schema: plain grouped sums, combined before shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.functions.calendar import date_key
from brookledger.plans.gold import valid_rows


def calendar_activity(
    calendar: DataFrame, silver_transactions: DataFrame, silver_fraud_flags: DataFrame
) -> DataFrame:
    """Every calendar day with its valid transactions and fraud flags."""
    moved = (
        valid_rows(silver_transactions)
        .groupBy(F.col("transaction_date_key").alias("date_key"))
        .agg(F.count(F.lit(1)).alias("transaction_count"))
    )
    flagged = (
        valid_rows(silver_fraud_flags)
        .groupBy(date_key(F.to_date("flagged_at")).alias("date_key"))
        .agg(F.count(F.lit(1)).alias("flag_count"))
    )
    return (
        calendar.join(moved, "date_key", "left")
        .join(flagged, "date_key", "left")
        .fillna(0, ["transaction_count", "flag_count"])
    )


def aml_activity(
    fact_transactions: DataFrame, fact_fraud: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Flagged money by customer, month and severity.

    Flags are joined to their transaction by surrogate key, a fact-to-fact
    join on ids that are unique on the transaction side.
    """
    amounts = fact_transactions.select("transaction_key", "amount_abs")
    months = calendar.select("date_key", "year_number", "month_number")
    flags = fact_fraud.select(
        "transaction_key", "customer_id", "date_key", "severity", "is_confirmed_fraud"
    )
    return (
        flags.join(F.broadcast(months), "date_key", "left")
        .join(amounts, "transaction_key", "left")
        .groupBy("customer_id", "year_number", "month_number", "severity")
        .agg(
            F.count(F.lit(1)).alias("flag_count"),
            F.sum("amount_abs").alias("flagged_amount"),
            F.count_if(F.col("is_confirmed_fraud")).alias("confirmed_count"),
        )
    )


def severity_ranking(fact_fraud: DataFrame) -> DataFrame:
    """Mean score and confirmed share by severity and score band."""
    flags = F.count(F.lit(1))
    return fact_fraud.groupBy("severity_rank", "severity", "fraud_score_band").agg(
        flags.alias("flag_count"),
        F.round(F.sum("fraud_score").cast("double") / flags, 4).alias("mean_score"),
        F.round(F.count_if(F.col("is_confirmed_fraud")) * 100.0 / flags, 2)
        .cast("double")
        .alias("confirmed_pct"),
    )


def review_sla(fact_fraud: DataFrame, calendar: DataFrame) -> DataFrame:
    """Share of flags reviewed in time by month and severity."""
    months = calendar.select("date_key", "year_number", "month_number")
    flags = F.count(F.lit(1))
    return (
        fact_fraud.join(F.broadcast(months), "date_key", "left")
        .groupBy("year_number", "month_number", "severity")
        .agg(
            flags.alias("flag_count"),
            F.count_if(F.col("review_sla_met")).alias("met_count"),
            F.round(F.count_if(F.col("review_sla_met")) * 100.0 / flags, 2)
            .cast("double")
            .alias("met_pct"),
        )
    )
