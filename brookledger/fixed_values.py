"""Values that are part of the data contract.

They are fixed: results are only right when they are exactly these, so they
live here as plain text and nowhere else in the package.
"""

from __future__ import annotations

import datetime as dt

# ---- entities and source columns, in file order ---------------------------
SOURCE_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone",
        "date_of_birth", "address_line1", "address_line2", "city", "state",
        "zip_code", "country", "customer_since", "status", "credit_score",
        "created_at", "updated_at",
    ],
    "accounts": [
        "account_id", "customer_id", "account_number", "account_type",
        "balance", "available_balance", "currency", "interest_rate",
        "opened_date", "status", "branch_code", "created_at", "updated_at",
    ],
    "transactions": [
        "transaction_id", "account_id", "customer_id", "transaction_type",
        "amount", "currency", "balance_after", "description",
        "merchant_name", "merchant_category", "channel", "status",
        "transaction_date", "value_date", "reference_number", "created_at",
    ],
    "fraud_flags": [
        "flag_id", "transaction_id", "account_id", "customer_id",
        "flag_reason", "severity", "fraud_score", "is_confirmed_fraud",
        "flagged_at", "reviewed_at", "reviewed_by", "created_at",
    ],
}
ENTITIES = list(SOURCE_COLUMNS)
BUSINESS_KEY = {
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
    "fraud_flags": "flag_id",
}
LINEAGE_COLUMNS = [
    "_source_file", "_source_entity", "_load_timestamp", "_batch_id", "_checksum",
]

# ---- CSV format -----------------------------------------------------------
NULL_TOKENS = ["NULL", "null", "None", ""]
BATCH_PREFIX = "BATCH_"
LANDING_EXTENSIONS = [".csv", ".json", ".parquet"]
LANDING_MAX_MB = 500

# ---- domains --------------------------------------------------------------
ACCOUNT_TYPES = ["CHECKING", "SAVINGS", "LOAN", "CREDIT"]
TRANSACTION_TYPES = ["DEPOSIT", "WITHDRAWAL", "TRANSFER", "PAYMENT", "FEE"]
TRANSACTION_STATUSES = ["PENDING", "COMPLETED", "FAILED", "REVERSED"]
CUSTOMER_STATUSES = ["ACTIVE", "INACTIVE", "SUSPENDED"]
FRAUD_SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
CHANNELS = ["ATM", "ONLINE", "MOBILE", "BRANCH", "POS"]
CREDIT_SCORE_RANGE = (300, 850)
FRAUD_SCORE_RANGE = (0, 1)

# ---- bands: (bound, label) pairs, then the label for everything else ------
CREDIT_TIERS_AT_LEAST = (
    [(800, "EXCEPTIONAL"), (740, "VERY_GOOD"), (670, "GOOD"), (580, "FAIR")],
    "POOR",
)
FRAUD_BANDS_AT_LEAST = (
    [("0.9", "CRITICAL"), ("0.7", "HIGH"), ("0.5", "MEDIUM")],
    "LOW",
)
DURATION_BANDS_BELOW = (
    [(365, "0-1 Years"), (730, "1-2 Years"), (1825, "2-5 Years"),
     (3650, "5-10 Years")],
    "10+ Years",
)
AGE_BANDS_BELOW = (
    [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"),
     (65, "55-64")],
    "65+",
)
SEVERITY_RANK = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}
ACCOUNT_TYPE_DESCRIPTION = {
    "CHECKING": "Checking Account",
    "SAVINGS": "Savings Account",
    "LOAN": "Loan Account",
    "CREDIT": "Credit Card Account",
}
ACCOUNT_TYPE_OTHER = "Unknown"
REVIEW_SLA_DAYS = 3
ACTIVE = "ACTIVE"

# ---- Silver row validity: the first missing column names the issue --------
REQUIRED_IN_SILVER: dict[str, list[tuple[str, str]]] = {
    "customers": [
        ("customer_id", "Missing customer_id"),
        ("email", "Missing or invalid email"),
        ("date_of_birth", "Missing or invalid date_of_birth"),
        ("status", "Missing status"),
    ],
    "accounts": [
        ("account_id", "Missing account_id"),
        ("customer_id", "Missing customer_id"),
        ("account_type", "Missing account_type"),
    ],
    "transactions": [
        ("transaction_id", "Missing transaction_id"),
        ("account_id", "Missing account_id"),
        ("amount", "Missing or invalid amount"),
        ("transaction_date", "Missing or invalid transaction_date"),
    ],
    "fraud_flags": [
        ("flag_id", "Missing flag_id"),
        ("transaction_id", "Missing transaction_id"),
        ("fraud_score", "Missing or invalid fraud_score"),
    ],
}

# ---- rejects --------------------------------------------------------------
REJECT_PREFIX = "REJ_"
REJECT_UNKNOWN_REASON = "Unknown DQ failure"
REJECT_PIPELINE = "bronze_to_silver_dag"
REJECT_SEVERITY = {
    "customers": "HIGH",
    "accounts": "HIGH",
    "transactions": "CRITICAL",
    "fraud_flags": "CRITICAL",
}
REJECT_ID_COLUMNS = {
    "customers": ["customer_id"],
    "accounts": ["account_id", "customer_id"],
    "transactions": ["account_id", "transaction_id", "customer_id"],
    "fraud_flags": ["transaction_id", "account_id", "customer_id"],
}
REJECT_LISTING_ROWS = 20

# ---- calendar -------------------------------------------------------------
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_DAYS = 2922

# ---- customer history -----------------------------------------------------
HISTORY_START = dt.date(2024, 1, 1)
OPEN_END = dt.date(9999, 12, 31)
TRACKED_COLUMNS = ["status", "credit_score", "credit_tier", "city", "state"]
HASH_SEPARATOR = "|"
SCD2_MESSAGE = "SCD2 Complete — Inserted: %s | Expired: %s | Unchanged: %s"
SCD2_RUN_PREFIX = "SCD2_"
SCD2_PIPELINE = "SP_SCD2_DIM_CUSTOMERS"
HISTORY_LISTING_ROWS = 20

# ---- contract defaults and lengths ----------------------------------------
DEFAULT_COUNTRY = "US"
DEFAULT_CURRENCY = "USD"
DEFAULT_TRANSACTION_STATUS = "COMPLETED"
ACCOUNT_MASK = "****"

# ---- escalation: severity -> (response time, owner) -----------------------
ESCALATION = {
    "CRITICAL": ("15 minutes", "On-call engineer + data lead"),
    "HIGH": ("1 hour", "Data team"),
    "MEDIUM": ("4 hours", "Data engineer"),
    "LOW": ("Next business day", "Logged only"),
}
