"""Source contracts: what each field of an extract must look like.

A row is checked as text, before any cleaning. Its broken fields are listed in
field order; fields with a default take it when they are absent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookledger.fixed_values import (
    ACCOUNT_TYPES,
    ACTIVE,
    BUSINESS_KEY,
    CREDIT_SCORE_RANGE,
    CUSTOMER_STATUSES,
    DEFAULT_COUNTRY,
    DEFAULT_CURRENCY,
    DEFAULT_TRANSACTION_STATUS,
    FRAUD_SCORE_RANGE,
    FRAUD_SEVERITIES,
    TRANSACTION_STATUSES,
    TRANSACTION_TYPES,
)
from brookledger.functions.calendar import moment
from brookledger.functions.casts import iso_date, iso_timestamp
from brookledger.functions.masking import is_masked, mask_account_number

# A contract is a list of (field, condition under which the field is fine).
Contract = list[tuple[str, Column]]


def _present(name: str) -> Column:
    return F.col(name).isNotNull()


def _length(name: str, most: int, least: int = 0) -> Column:
    return F.length(name).between(least, most)


def _optional(name: str, rule: Column) -> Column:
    return F.col(name).isNull() | rule


def _date(name: str) -> Column:
    return iso_date(name).isNotNull()


def _time(name: str) -> Column:
    return iso_timestamp(name).isNotNull()


def _decimal(name: str) -> Column:
    return F.col(name).try_cast("decimal(38,10)").isNotNull()


def _customers() -> Contract:
    low, high = CREDIT_SCORE_RANGE
    whole = F.col("credit_score").rlike(r"^\s*[+-]?\d+\s*$")
    return [
        ("customer_id", _present("customer_id")),
        ("first_name", _length("first_name", 50, 1)),
        ("last_name", _length("last_name", 50, 1)),
        ("email", F.contains(F.col("email"), F.lit("@"))),
        ("phone", _present("phone")),
        ("date_of_birth", _date("date_of_birth")),
        ("address_line1", _length("address_line1", 100)),
        ("address_line2", _optional("address_line2", _length("address_line2", 100))),
        ("city", _length("city", 50)),
        ("state", _length("state", 2)),
        ("zip_code", _length("zip_code", 10)),
        ("country", _length("country", 2)),
        ("customer_since", _date("customer_since")),
        ("status", F.col("status").isin(CUSTOMER_STATUSES)),
        (
            "credit_score",
            whole & F.col("credit_score").try_cast("int").between(low, high),
        ),
        ("created_at", _optional("created_at", _time("created_at"))),
        ("updated_at", _optional("updated_at", _time("updated_at"))),
    ]


def _accounts() -> Contract:
    return [
        ("account_id", _present("account_id")),
        ("customer_id", _present("customer_id")),
        ("account_number", _present("account_number")),
        ("account_type", F.col("account_type").isin(ACCOUNT_TYPES)),
        ("balance", _decimal("balance")),
        ("available_balance", _decimal("available_balance")),
        ("currency", _length("currency", 3)),
        ("interest_rate", F.col("interest_rate").try_cast("decimal(38,10)") >= 0),
        ("opened_date", _date("opened_date")),
        ("branch_code", _present("branch_code")),
        ("created_at", _optional("created_at", _time("created_at"))),
        ("updated_at", _optional("updated_at", _time("updated_at"))),
    ]


def _transactions() -> Contract:
    return [
        ("transaction_id", _present("transaction_id")),
        ("account_id", _present("account_id")),
        ("customer_id", _present("customer_id")),
        ("transaction_type", F.col("transaction_type").isin(TRANSACTION_TYPES)),
        ("amount", _decimal("amount")),
        ("currency", _length("currency", 3)),
        ("balance_after", _decimal("balance_after")),
        ("description", _length("description", 200)),
        ("merchant_name", _optional("merchant_name", _length("merchant_name", 100))),
        (
            "merchant_category",
            _optional("merchant_category", _length("merchant_category", 50)),
        ),
        ("channel", _present("channel")),
        ("status", F.col("status").isin(TRANSACTION_STATUSES)),
        ("transaction_date", _time("transaction_date")),
        ("value_date", _date("value_date")),
        ("reference_number", _present("reference_number")),
        ("created_at", _optional("created_at", _time("created_at"))),
    ]


def _fraud_flags() -> Contract:
    low, high = FRAUD_SCORE_RANGE
    score = F.col("fraud_score").try_cast("double")
    flag_words = ("true", "t", "yes", "y", "on", "1", "false", "f", "no", "n", "off", "0")
    return [
        ("flag_id", _present("flag_id")),
        ("transaction_id", _present("transaction_id")),
        ("account_id", _present("account_id")),
        ("customer_id", _present("customer_id")),
        ("flag_reason", _present("flag_reason")),
        ("severity", F.col("severity").isin(FRAUD_SEVERITIES)),
        ("fraud_score", score.between(float(low), float(high))),
        (
            "is_confirmed_fraud",
            _optional("is_confirmed_fraud", F.lower("is_confirmed_fraud").isin(*flag_words)),
        ),
        ("flagged_at", _optional("flagged_at", _time("flagged_at"))),
        ("reviewed_at", _optional("reviewed_at", _time("reviewed_at"))),
        ("created_at", _optional("created_at", _time("created_at"))),
    ]


_CONTRACTS = {
    "customers": _customers,
    "accounts": _accounts,
    "transactions": _transactions,
    "fraud_flags": _fraud_flags,
}
_DEFAULTS = {
    "customers": {"country": DEFAULT_COUNTRY, "status": ACTIVE},
    "accounts": {"currency": DEFAULT_CURRENCY, "status": ACTIVE},
    "transactions": {"currency": DEFAULT_CURRENCY, "status": DEFAULT_TRANSACTION_STATUS},
    "fraud_flags": {"is_confirmed_fraud": "False"},
}
_TIMES_DEFAULTING_TO_NOW = {
    "customers": ["created_at", "updated_at"],
    "accounts": ["created_at", "updated_at"],
    "transactions": ["created_at"],
    "fraud_flags": ["flagged_at", "created_at"],
}


def validate(raw: DataFrame, entity: str, as_of: dt.datetime) -> DataFrame:
    """Source rows with defaults filled in, their broken fields and a verdict."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in _DEFAULTS[entity].items()
    }
    now = moment(as_of).cast("string")
    filled |= {n: F.coalesce(F.col(n), now) for n in _TIMES_DEFAULTING_TO_NOW[entity]}
    rows = raw.withColumns(filled)
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
                for name, rule in _CONTRACTS[entity]()
            ]
        )
    )
    checked = rows.withColumn("violations", F.array_join(broken, ",")).withColumn(
        "is_valid", F.col("violations") == ""
    )
    return checked.withColumn("email", F.lower("email")) if entity == "customers" else checked


def verdicts(raw: DataFrame, entity: str, as_of: dt.datetime) -> DataFrame:
    """Key, broken fields and verdict of each row, and its defaulted fields."""
    key = BUSINESS_KEY[entity]
    extra = ["email"] if entity == "customers" else []
    return validate(raw, entity, as_of).select(
        key, *extra, *_DEFAULTS[entity], *_TIMES_DEFAULTING_TO_NOW[entity],
        "violations", "is_valid",
    )


def masked_accounts(raw_accounts: DataFrame, number: str = "account_number") -> DataFrame:
    """Account numbers with all but the last four characters hidden."""
    return raw_accounts.select(
        "account_id",
        is_masked(F.col(number)).alias("was_masked"),
        mask_account_number(F.col(number)).alias("account_number"),
    )
