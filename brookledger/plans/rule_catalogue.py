"""The data-quality rules, as data.

Fixed values: rule ids, names, severities, actions, reason codes and check
texts are part of the contract. A predicate is SQL that is true for a row
that breaks the rule; a row for which it is unknown is not counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from brookledger.fixed_values import (
    ACCOUNT_TYPES,
    CHANNELS,
    CUSTOMER_STATUSES,
    FRAUD_SEVERITIES,
    TRANSACTION_STATUSES,
    TRANSACTION_TYPES,
)


@dataclass(frozen=True)
class Measure:
    """What a rule counts in one table.

    ``kind``: ``rows`` (all rows), ``breaches`` (rows matching ``predicate``),
    ``percent`` (share of rows matching it), ``repeats`` (values of ``column``
    that occur more than once), ``not_one`` (values of ``column`` for which
    not exactly one row matches ``predicate``).
    """

    kind: str
    predicate: str = ""
    column: str = ""


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_name: str
    table: str
    measure: Measure
    expected: str
    severity: str
    action: str
    reason_code: str | None = None


@dataclass(frozen=True)
class Check:
    check_name: str
    description: str
    layer: str
    table: str
    severity: str
    measure: Measure
    expected: str


def one_of(column: str, domain: list[str]) -> str:
    return f"{column} not in ({', '.join(repr(v) for v in domain)})"


ROWS = Measure("rows")
BAND_DOMAIN = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def breach(predicate: str) -> Measure:
    return Measure("breaches", predicate=predicate)


def missing(column: str) -> Measure:
    return breach(f"{column} is null")


def repeats(column: str) -> Measure:
    return Measure("repeats", column=column)


SCORE_OUT = breach("credit_score < 300 or credit_score > 850")
FRAUD_OUT = breach("fraud_score < 0 or fraud_score > 1")
VALID_SHARE = Measure("percent", predicate="dq_is_valid")
UNREADABLE_DATE = breach(
    r"transaction_date is not null and coalesce(case when rlike(transaction_date, "
    r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast(transaction_date as timestamp_ntz) end) "
    r"is null"
)
ONE_CURRENT = Measure("not_one", predicate="is_current", column="customer_id")

REJECT, REJECT_REPEATS = "Reject record", "Reject duplicates"
FAIL, WARN, FLAG, ALERT = "Fail pipeline", "Warning", "Flag record", "Alert"
NONE, SOME, PASSING = "= 0", "> 0", ">= 95"

BRONZE_RULES = [
    Rule("BQ-001", "ROW_COUNT_NOT_ZERO", "raw_customers", ROWS, SOME, "CRITICAL", FAIL),
    Rule("BQ-002", "NO_NULL_CUSTOMER_ID", "raw_customers", missing("customer_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("BQ-003", "NO_NULL_EMAIL", "raw_customers", missing("email"), NONE, "HIGH", REJECT, "INVALID_FORMAT"),
    Rule("BQ-004", "VALID_EMAIL_FORMAT", "raw_customers", breach("instr(email, '@') = 0"), NONE, "HIGH", REJECT, "INVALID_FORMAT"),
    Rule("BQ-005", "NO_NULL_STATUS", "raw_customers", missing("status"), NONE, "CRITICAL", REJECT, "INVALID_DOMAIN"),
    Rule("BQ-006", "SOURCE_FILE_PRESENT", "raw_customers", missing("_source_file"), NONE, "MEDIUM", WARN),
    Rule("BQ-007", "BATCH_ID_PRESENT", "raw_customers", missing("_batch_id"), NONE, "MEDIUM", WARN),
    Rule("BQ-008", "ROW_COUNT_NOT_ZERO", "raw_accounts", ROWS, SOME, "CRITICAL", FAIL),
    Rule("BQ-009", "NO_NULL_ACCOUNT_ID", "raw_accounts", missing("account_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("BQ-010", "NO_NULL_CUSTOMER_ID", "raw_accounts", missing("customer_id"), NONE, "CRITICAL", REJECT, "REFERENTIAL_INTEGRITY"),
    Rule("BQ-011", "NO_NULL_ACCOUNT_TYPE", "raw_accounts", missing("account_type"), NONE, "CRITICAL", REJECT, "INVALID_DOMAIN"),
    Rule("BQ-012", "NO_NULL_BALANCE", "raw_accounts", missing("balance"), NONE, "HIGH", REJECT, "INVALID_FORMAT"),
    Rule("BQ-013", "ROW_COUNT_NOT_ZERO", "raw_transactions", ROWS, SOME, "CRITICAL", FAIL),
    Rule("BQ-014", "NO_NULL_TRANSACTION_ID", "raw_transactions", missing("transaction_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("BQ-015", "NO_NULL_ACCOUNT_ID", "raw_transactions", missing("account_id"), NONE, "CRITICAL", REJECT, "REFERENTIAL_INTEGRITY"),
    Rule("BQ-016", "NO_NULL_AMOUNT", "raw_transactions", missing("amount"), NONE, "CRITICAL", REJECT, "INVALID_FORMAT"),
    Rule("BQ-017", "NO_NULL_TRANSACTION_DATE", "raw_transactions", missing("transaction_date"), NONE, "CRITICAL", REJECT, "INVALID_DATE"),
    Rule("BQ-018", "VALID_TRANSACTION_DATE", "raw_transactions", UNREADABLE_DATE, NONE, "HIGH", REJECT, "INVALID_DATE"),
    Rule("BQ-019", "ROW_COUNT_NOT_ZERO", "raw_fraud_flags", ROWS, SOME, "HIGH", WARN),
    Rule("BQ-020", "NO_NULL_FLAG_ID", "raw_fraud_flags", missing("flag_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("BQ-021", "NO_NULL_TRANSACTION_ID", "raw_fraud_flags", missing("transaction_id"), NONE, "CRITICAL", REJECT, "REFERENTIAL_INTEGRITY"),
    Rule("BQ-022", "NO_NULL_FRAUD_SCORE", "raw_fraud_flags", missing("fraud_score"), NONE, "HIGH", REJECT, "INVALID_FORMAT"),
]

SILVER_RULES = [
    Rule("SQ-001", "ROW_COUNT_NOT_ZERO", "silver_customers", ROWS, SOME, "CRITICAL", FAIL),
    Rule("SQ-002", "NO_NULL_CUSTOMER_ID", "silver_customers", missing("customer_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("SQ-003", "NO_NULL_EMAIL", "silver_customers", missing("email"), NONE, "HIGH", REJECT, "INVALID_FORMAT"),
    Rule("SQ-004", "NO_DUPLICATE_CUSTOMER_ID", "silver_customers", repeats("customer_id"), NONE, "CRITICAL", REJECT_REPEATS, "DUPLICATE_KEY"),
    Rule("SQ-005", "VALID_STATUS_DOMAIN", "silver_customers", breach(one_of("status", CUSTOMER_STATUSES)), NONE, "HIGH", REJECT, "INVALID_DOMAIN"),
    Rule("SQ-006", "VALID_CREDIT_SCORE_RANGE", "silver_customers", SCORE_OUT, NONE, "HIGH", REJECT, "OUT_OF_RANGE"),
    Rule("SQ-007", "VALID_DATE_OF_BIRTH", "silver_customers", missing("date_of_birth"), NONE, "MEDIUM", FLAG, "INVALID_DATE"),
    Rule("SQ-008", "VALID_STATE_CODE", "silver_customers", breach("not rlike(state, '^[A-Z]{2}$')"), NONE, "LOW", WARN, "INVALID_DOMAIN"),
    Rule("SQ-009", "DQ_PASS_RATE_95", "silver_customers", VALID_SHARE, PASSING, "CRITICAL", FAIL),
    Rule("SQ-010", "ROW_COUNT_NOT_ZERO", "silver_accounts", ROWS, SOME, "CRITICAL", FAIL),
    Rule("SQ-011", "NO_NULL_ACCOUNT_ID", "silver_accounts", missing("account_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("SQ-012", "NO_NULL_CUSTOMER_ID", "silver_accounts", missing("customer_id"), NONE, "CRITICAL", REJECT, "REFERENTIAL_INTEGRITY"),
    Rule("SQ-013", "NO_DUPLICATE_ACCOUNT_ID", "silver_accounts", repeats("account_id"), NONE, "CRITICAL", REJECT_REPEATS, "DUPLICATE_KEY"),
    Rule("SQ-014", "VALID_ACCOUNT_TYPE", "silver_accounts", breach(one_of("account_type", ACCOUNT_TYPES)), NONE, "CRITICAL", REJECT, "INVALID_DOMAIN"),
    Rule("SQ-015", "VALID_BALANCE_TYPE", "silver_accounts", missing("balance"), NONE, "HIGH", REJECT, "INVALID_FORMAT"),
    Rule("SQ-016", "ROW_COUNT_NOT_ZERO", "silver_transactions", ROWS, SOME, "CRITICAL", FAIL),
    Rule("SQ-017", "NO_NULL_TRANSACTION_ID", "silver_transactions", missing("transaction_id"), NONE, "CRITICAL", REJECT, "NULL_PK"),
    Rule("SQ-018", "NO_NULL_AMOUNT", "silver_transactions", missing("amount"), NONE, "CRITICAL", REJECT, "INVALID_FORMAT"),
    Rule("SQ-019", "NO_DUPLICATE_TRANSACTION_ID", "silver_transactions", repeats("transaction_id"), NONE, "CRITICAL", REJECT_REPEATS, "DUPLICATE_KEY"),
    Rule("SQ-020", "VALID_TRANSACTION_TYPE", "silver_transactions", breach(one_of("transaction_type", TRANSACTION_TYPES)), NONE, "HIGH", REJECT, "INVALID_DOMAIN"),
    Rule("SQ-021", "VALID_CHANNEL", "silver_transactions", breach(one_of("channel", CHANNELS)), NONE, "MEDIUM", FLAG, "INVALID_DOMAIN"),
    Rule("SQ-022", "VALID_STATUS", "silver_transactions", breach(one_of("status", TRANSACTION_STATUSES)), NONE, "HIGH", REJECT, "INVALID_DOMAIN"),
    Rule("SQ-023", "AMOUNT_NOT_ZERO", "silver_transactions", breach("amount = 0"), NONE, "HIGH", REJECT, "ZERO_AMOUNT"),
    Rule("SQ-024", "ROW_COUNT_NOT_ZERO", "silver_fraud_flags", ROWS, SOME, "HIGH", WARN),
    Rule("SQ-025", "VALID_FRAUD_SCORE_RANGE", "silver_fraud_flags", FRAUD_OUT, NONE, "HIGH", REJECT, "OUT_OF_RANGE"),
    Rule("SQ-026", "VALID_SEVERITY_DOMAIN", "silver_fraud_flags", breach(one_of("severity", FRAUD_SEVERITIES)), NONE, "HIGH", REJECT, "INVALID_DOMAIN"),
    Rule("SQ-027", "NO_DUPLICATE_FLAG_ID", "silver_fraud_flags", repeats("flag_id"), NONE, "CRITICAL", REJECT_REPEATS, "DUPLICATE_KEY"),
]

GOLD_RULES = [
    Rule("GQ-001", "DIM_CUSTOMERS_ROW_COUNT", "dim_customers", ROWS, SOME, "CRITICAL", FAIL),
    Rule("GQ-002", "DIM_ACCOUNTS_ROW_COUNT", "dim_accounts", ROWS, SOME, "CRITICAL", FAIL),
    Rule("GQ-003", "DIM_DATE_ROW_COUNT", "dim_date", ROWS, "= 2922", "HIGH", ALERT),
    Rule("GQ-004", "DIM_CUSTOMERS_NO_DUPES", "dim_customers", repeats("customer_id"), NONE, "CRITICAL", ALERT, "DUPLICATE_KEY"),
    Rule("GQ-005", "DIM_ACCOUNTS_NO_DUPES", "dim_accounts", repeats("account_id"), NONE, "CRITICAL", ALERT, "DUPLICATE_KEY"),
    Rule("GQ-006", "SCD2_IS_CURRENT_FLAG", "dim_customers_history", ONE_CURRENT, NONE, "CRITICAL", ALERT, "DUPLICATE_KEY"),
    Rule("GQ-007", "FACT_TXN_ROW_COUNT", "fact_transactions", ROWS, SOME, "CRITICAL", FAIL),
    Rule("GQ-008", "FACT_FRAUD_ROW_COUNT", "fact_fraud", ROWS, SOME, "HIGH", WARN),
    Rule("GQ-009", "FACT_TXN_ACCOUNT_KEY_RI", "fact_transactions", missing("account_key"), NONE, "HIGH", ALERT, "REFERENTIAL_INTEGRITY"),
    Rule("GQ-010", "FACT_TXN_CUSTOMER_KEY_RI", "fact_transactions", missing("customer_key"), NONE, "HIGH", ALERT, "REFERENTIAL_INTEGRITY"),
    Rule("GQ-011", "FACT_TXN_DATE_KEY_RI", "fact_transactions", missing("date_key"), NONE, "MEDIUM", ALERT, "REFERENTIAL_INTEGRITY"),
    Rule("GQ-012", "FACT_FRAUD_SCORE_BAND", "fact_fraud", breach(one_of("fraud_score_band", BAND_DOMAIN)), NONE, "MEDIUM", ALERT, "INVALID_DOMAIN"),
    Rule("GQ-013", "FACT_TXN_NO_DUPES", "fact_transactions", repeats("transaction_id"), NONE, "CRITICAL", ALERT, "DUPLICATE_KEY"),
]

SILVER_CHECKS = [
    Check("silver_customers_row_count", "Silver customers must have records", "SILVER", "silver_customers", "CRITICAL", ROWS, SOME),
    Check("silver_transactions_row_count", "Silver transactions must have records", "SILVER", "silver_transactions", "CRITICAL", ROWS, SOME),
    Check("silver_accounts_row_count", "Silver accounts must have records", "SILVER", "silver_accounts", "CRITICAL", ROWS, SOME),
    Check("silver_customers_no_null_ids", "Customer IDs must not be null", "SILVER", "silver_customers", "CRITICAL", missing("customer_id"), NONE),
    Check("silver_transactions_no_null_amounts", "Transaction amounts must not be null", "SILVER", "silver_transactions", "CRITICAL", missing("amount"), NONE),
    Check("silver_customers_no_null_emails", "Customer emails must not be null", "SILVER", "silver_customers", "HIGH", missing("email"), NONE),
    Check("silver_customers_no_duplicates", "Customer IDs must be unique", "SILVER", "silver_customers", "CRITICAL", repeats("customer_id"), NONE),
    Check("silver_transactions_no_duplicates", "Transaction IDs must be unique", "SILVER", "silver_transactions", "CRITICAL", repeats("transaction_id"), NONE),
    Check("silver_customers_valid_status", "Customer status must be ACTIVE/INACTIVE/SUSPENDED", "SILVER", "silver_customers", "HIGH", breach(one_of("status", CUSTOMER_STATUSES)), NONE),
    Check("silver_customers_valid_credit_score", "Credit scores must be between 300 and 850", "SILVER", "silver_customers", "HIGH", SCORE_OUT, NONE),
    Check("silver_fraud_valid_score_range", "Fraud scores must be between 0 and 1", "SILVER", "silver_fraud_flags", "HIGH", FRAUD_OUT, NONE),
    Check("silver_dq_pass_rate", "At least 95% of records must pass DQ validation", "SILVER", "silver_customers", "CRITICAL", VALID_SHARE, PASSING),
]

GOLD_CHECKS = [
    Check("gold_dim_customers_row_count", "DIM_CUSTOMERS must have records", "GOLD", "dim_customers", "CRITICAL", ROWS, SOME),
    Check("gold_fact_transactions_row_count", "FACT_TRANSACTIONS must have records", "GOLD", "fact_transactions", "CRITICAL", ROWS, SOME),
    Check("gold_fact_txn_account_key_integrity", "All transactions must have valid account keys", "GOLD", "fact_transactions", "HIGH", missing("account_key"), NONE),
    Check("gold_fact_txn_customer_key_integrity", "All transactions must have valid customer keys", "GOLD", "fact_transactions", "HIGH", missing("customer_key"), NONE),
    Check("gold_dim_customers_no_duplicates", "DIM_CUSTOMERS must have unique customer_ids", "GOLD", "dim_customers", "CRITICAL", repeats("customer_id"), NONE),
    Check("gold_fraud_score_band_valid", "Fraud score bands must be valid values", "GOLD", "fact_fraud", "MEDIUM", breach(one_of("fraud_score_band", BAND_DOMAIN)), NONE),
    Check("gold_dim_date_row_count", "DIM_DATE must have 2922 rows (2020-2027)", "GOLD", "dim_date", "HIGH", ROWS, "= 2922"),
]
