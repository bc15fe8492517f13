"""One DuckDB statement per query, keyed by the query's name."""

from __future__ import annotations

from brookledger.fixed_values import ENTITIES
from verification.quality_oracles import QUALITY_ORACLES, SILVER_SUITE
from verification.relations import HASH, NOW, with_relations, yyyymmdd
from verification.source_oracles import SOURCE_ORACLES

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str, extra: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_relations(sql, extra)


for _e in ENTITIES:
    oracle(f"silver_{_e}", f"select * from silver_{_e}")
    oracle(f"rejects_{_e}", f"select * from rejects_{_e}")
oracle("silver_customers_rolled_forward", "select * from silver_customers")
oracle("reject_records", "select * from reject_records")
oracle(
    "reject_summary",
    """select source_table, severity, count(*) as reject_count,
           min(rejected_at) as first_rejection, max(rejected_at) as last_rejection
       from reject_records group by all""",
)
oracle(
    "latest_rejects",
    """select reject_id, source_table, source_layer, entity, reject_reason, severity,
           customer_id, transaction_id, rejected_at
       from reject_records
       order by rejected_at desc, reject_id, source_table limit 20""",
)
oracle(
    "duplicate_rejects",
    " union all by name ".join(f"select * from duplicates_{e}" for e in ENTITIES),
)
for _t in ("dim_customers", "dim_accounts", "fact_transactions", "fact_fraud"):
    oracle(_t, f"select * from {_t}")

oracle("fact_transactions_over_history", "select * from fact_over_history")

oracle(
    "fact_transactions_by_changes",
    """select f.* replace (h.transaction_key as transaction_key, h.account_key as account_key,
           h.customer_key as customer_key)
       from fact_transactions f join fact_over_history h using (transaction_id)""",
)
oracle(
    "fact_fraud_by_changes",
    """select f.* replace (k.flag_key as fraud_key, t.transaction_key as transaction_key,
           a.account_key as account_key, c.customer_key as customer_key)
       from fact_fraud f join lasting_fraud_flags k on k.flag_id = f.flag_id
       left join lasting_transactions t on t.transaction_id = f.transaction_id
       left join lasting_accounts a on a.account_id = f.account_id
       left join (select customer_id, customer_key from history where is_current) c
         on c.customer_id = f.customer_id""",
)

# ---- verification ---------------------------------------------------------
def _counts(tables: dict[str, str], more: str = "") -> str:
    return " union all ".join(
        f"select '{label}' as table_name, count(*) as row_count{more} from {name}"
        for label, name in tables.items()
    )


oracle("bronze_row_counts", _counts({f"RAW_{e.upper()}": f"both_{e}" for e in ENTITIES}))
oracle(
    "bronze_batches",
    """select _batch_id, _source_entity, count(*) as records_loaded,
           min(_load_timestamp) as load_started, max(_load_timestamp) as load_completed
       from both_customers group by all""",
)
oracle(
    "bronze_null_profile",
    """select count(*) as total_records,
           count(*) filter (where customer_id is null) as null_customer_ids,
           count(*) filter (where email is null) as null_emails,
           count(*) filter (where status is null) as null_statuses
       from both_customers""",
)
oracle(
    "bronze_sample_customers",
    "select * from both_customers order by customer_id nulls last limit 5",
)
oracle(
    "bronze_sample_transactions",
    "select * from both_transactions order by transaction_id nulls last limit 5",
)
_SILVER = {f"SILVER_{e.upper()}": f"silver_{e}" for e in ENTITIES}
oracle("silver_row_counts", _counts(_SILVER))
oracle(
    "silver_valid_counts",
    _counts(_SILVER, ", count(*) filter (where dq_is_valid) as valid_count"),
)
_GOLD = ("dim_date", "dim_customers", "dim_accounts", "fact_transactions", "fact_fraud")
oracle("gold_row_counts", _counts({t.upper(): t for t in _GOLD}))
_SILVER_LOADS = " union all ".join(
    f"""select 'SILVER_{e.upper()}_20280101_000000' as run_id,
        'bronze_to_silver' as pipeline_name, '{e}' as entity, 'SUCCESS' as status,
        count(*) as records_read,
        count(*) filter (where dq_is_valid) as records_loaded,
        count(*) filter (where not dq_is_valid) as records_failed,
        {NOW} as started_at, {NOW} as completed_at,
        cast(null as varchar) as error_message,
        cast(null as varchar) as s3_source_path, {NOW} as created_at
        from silver_{e}"""
    for e in ENTITIES
)
oracle("run_log", _SILVER_LOADS)
oracle(
    "run_log_observed",
    f"""{_SILVER_LOADS} union all
        select 'QUALITY_20280101_000000', 'data_quality', 'silver', 'FAILED', 0, 0, 0, {NOW}, {NOW},
            'Critical DQ checks failed: ['
                || string_agg(chr(39) || check_name || chr(39), ', ' order by check_name) || ']',
            null, {NOW}
        from ({SILVER_SUITE}) where status = 'FAILED' and severity = 'CRITICAL' having count(*) > 0""",
)
oracle(
    "dim_date_activity",
    f"""select c.*, coalesce(t.n, 0) as transaction_count, coalesce(f.n, 0) as flag_count
        from dim_date c
        left join (select transaction_date_key as k, count(*) as n from silver_transactions
                   where dq_is_valid group by 1) t on t.k = c.date_key
        left join (select {yyyymmdd('flagged_at')} as k, count(*) as n
                   from silver_fraud_flags where dq_is_valid group by 1) f
          on f.k = c.date_key""",
)

# ---- customer history -----------------------------------------------------
oracle("scd2_bootstrap", "select * from dim_first")
oracle("scd2_record_hash", f"select customer_id, {HASH} as record_hash from silver_customers")
oracle("scd2_classify", "select * from history_changes")
oracle("scd2_expire", "select * from history_expired")
oracle("scd2_insert_versions", "select * from history_inserted")
oracle("scd2_dim_customers", "select * from history")
oracle("scd2_copy_on_write", "select * from history")
_MESSAGE = (
    "'SCD2 Complete — Inserted: ' || rows_inserted || ' | Expired: ' || rows_expired "
    "|| ' | Unchanged: ' || rows_unchanged"
)
oracle("scd2_run_summary", f"select *, {_MESSAGE} as message from history_counts")
oracle(
    "scd2_run_log",
    f"""select 'SCD2_20280101_000000' as run_id, 'SP_SCD2_DIM_CUSTOMERS' as pipeline_name,
        'DIM_CUSTOMERS' as entity, 'SUCCESS' as status, cast(0 as bigint) as records_read,
        rows_inserted as records_loaded, cast(0 as bigint) as records_failed,
        {NOW} as started_at, {NOW} as completed_at, cast(null as varchar) as error_message,
        cast(null as varchar) as s3_source_path, {NOW} as created_at
        from history_counts""",
)
oracle(
    "scd2_verify_counts",
    """select 'Current Records' as record_type, count(*) as count from history where is_current
       union all select 'Historical Records', count(*) from history where not is_current
       union all select 'Total Records', count(*) from history""",
)
oracle(
    "scd2_history_sample",
    """select customer_id, full_name, status, credit_score, credit_tier, city, state,
           effective_from, effective_to, is_current, record_hash
       from history order by customer_id, effective_from, effective_to limit 20""",
)
oracle(
    "scd2_as_of",
    """select as_of_day, h.* from history_middle h
       join (select unnest([date '2024-02-15', date '2025-06-29', date '2025-06-30',
                            date '2026-01-01']) as as_of_day)
         on as_of_day between effective_from and effective_to""",
)
oracle(
    "scd2_as_of_transactions",
    """select h.status as customer_status, count(*) as transactions,
           cast(sum(t.amount) as decimal(28,2)) as total_amount
       from silver_transactions t
       left join history_middle h on h.customer_id = t.customer_id
         and cast(t.transaction_date as date) between h.effective_from and h.effective_to
       where t.dq_is_valid group by 1""",
)

# ---- reports --------------------------------------------------------------
oracle(
    "report_aml_activity",
    """select f.customer_id, c.year_number, c.month_number, f.severity,
           count(*) as flag_count,
           cast(sum(t.amount_abs) as decimal(28,2)) as flagged_amount,
           count(*) filter (where f.is_confirmed_fraud) as confirmed_count
       from fact_fraud f
       left join fact_transactions t on t.transaction_key = f.transaction_key
       left join dim_date c on c.date_key = f.date_key
       group by all""",
)
oracle(
    "report_severity_ranking",
    """select severity_rank, severity, fraud_score_band, count(*) as flag_count,
           round(cast(sum(fraud_score) as double) / count(*), 4) as mean_score,
           round(count(*) filter (where is_confirmed_fraud) * 100.0 / count(*), 2)
               ::double as confirmed_pct
       from fact_fraud group by all""",
)
oracle(
    "report_review_sla",
    """select c.year_number, c.month_number, f.severity, count(*) as flag_count,
           count(*) filter (where f.review_sla_met) as met_count,
           round(count(*) filter (where f.review_sla_met) * 100.0 / count(*), 2)
               ::double as met_pct
       from fact_fraud f left join dim_date c on c.date_key = f.date_key
       group by all""",
)

ORACLES.update(QUALITY_ORACLES)
ORACLES.update(SOURCE_ORACLES)
