"""DuckDB SQL for every table of the lakehouse, written independently.

``with_relations`` prefixes a query with the common table expressions it
needs, so each oracle is one self-contained statement over the sample tables.
"""

from __future__ import annotations

import re

from brookledger.fixed_values import (
    BUSINESS_KEY,
    ENTITIES,
    SOURCE_COLUMNS,
)
from brookledger.sources.sample_tables import next_batch_sql, raw_sql

TODAY = "date '2028-01-01'"
NOW = "timestamp '2028-01-01 00:00:00'"
STAMP = "20280101_000000"


def d(column: str) -> str:
    """ISO date text to date, anything else to null."""
    return (
        f"case when regexp_matches({column}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"then try_cast({column} as date) end"
    )


def ts(column: str) -> str:
    return (
        f"case when regexp_matches({column}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"then try_cast({column} as timestamp) end"
    )


def word(expression: str) -> str:
    """Capitalise a single word."""
    return f"upper(trim({expression})[1]) || lower(trim({expression})[2:])"


def words(expression: str) -> str:
    """Capitalise each of several words, blanks between them kept."""
    split = f"string_split(lower(trim({expression})), ' ')"
    return f"array_to_string(list_transform({split}, lambda w: upper(w[1]) || w[2:]), ' ')"


def yyyymmdd(expression: str) -> str:
    return f"cast(strftime({expression}, '%Y%m%d') as integer)"


def duration_band(c: str) -> str:
    return (
        f"case when {c} < 365 then '0-1 Years' when {c} < 730 then '1-2 Years' "
        f"when {c} < 1825 then '2-5 Years' when {c} < 3650 then '5-10 Years' "
        "else '10+ Years' end"
    )


def age_band(c: str) -> str:
    return (
        f"case when {c} < 25 then '18-24' when {c} < 35 then '25-34' "
        f"when {c} < 45 then '35-44' when {c} < 55 then '45-54' "
        f"when {c} < 65 then '55-64' else '65+' end"
    )


def dense(alias: str, id_name: str) -> str:
    return f"row_number() over (order by md5({id_name}), {id_name}) as {alias}"


def _latest(entity: str, source: str) -> str:
    key = BUSINESS_KEY[entity]
    ties = ", ".join(
        f"{c} desc nulls last" for c in SOURCE_COLUMNS[entity] if c != key
    )
    return (
        f"select * from {source} qualify row_number() over (partition by {key} "
        f"order by _load_timestamp desc nulls first, _source_file desc nulls last, "
        f"{ties}) = 1"
    )


_REQUIRED = {
    "customers": [
        ("customer_id", "Missing customer_id"), ("email", "Missing or invalid email"),
        ("date_of_birth", "Missing or invalid date_of_birth"), ("status", "Missing status"),
    ],
    "accounts": [
        ("account_id", "Missing account_id"), ("customer_id", "Missing customer_id"),
        ("account_type", "Missing account_type"),
    ],
    "transactions": [
        ("transaction_id", "Missing transaction_id"), ("account_id", "Missing account_id"),
        ("amount", "Missing or invalid amount"),
        ("transaction_date", "Missing or invalid transaction_date"),
    ],
    "fraud_flags": [
        ("flag_id", "Missing flag_id"), ("transaction_id", "Missing transaction_id"),
        ("fraud_score", "Missing or invalid fraud_score"),
    ],
}


def _verdict(entity: str) -> str:
    rules = _REQUIRED[entity]
    valid = " and ".join(f"{c} is not null" for c, _ in rules)
    issue = " ".join(f"when {c} is null then '{m}'" for c, m in rules)
    return f"({valid}) as dq_is_valid, case {issue} end as dq_issues"


_CLEAN = {
    "customers": f"""
        select trim(customer_id) as customer_id, {word('first_name')} as first_name,
            {word('last_name')} as last_name,
            {word('first_name')} || ' ' || {word('last_name')} as full_name,
            lower(trim(email)) as email, trim(phone) as phone,
            {d('date_of_birth')} as date_of_birth,
            cast(year({TODAY}) - year({d('date_of_birth')}) as integer) as age_years,
            trim(address_line1) as address_line1, trim(address_line2) as address_line2,
            {word('city')} as city, upper(trim(state)) as state,
            trim(zip_code) as zip_code, upper(trim(country)) as country,
            {d('customer_since')} as customer_since,
            cast({TODAY} - {d('customer_since')} as integer) as tenure_days,
            upper(trim(status)) as status,
            cast(try_cast(credit_score as decimal(38,0)) as integer) as credit_score,
            case when try_cast(credit_score as decimal(38,0)) >= 800 then 'EXCEPTIONAL'
                 when try_cast(credit_score as decimal(38,0)) >= 740 then 'VERY_GOOD'
                 when try_cast(credit_score as decimal(38,0)) >= 670 then 'GOOD'
                 when try_cast(credit_score as decimal(38,0)) >= 580 then 'FAIR'
                 else 'POOR' end as credit_tier,
            {ts('created_at')} as created_at, {ts('updated_at')} as updated_at,
            _source_file, _batch_id""",
    "accounts": f"""
        select trim(account_id) as account_id, trim(customer_id) as customer_id,
            trim(account_number) as account_number,
            upper(trim(account_type)) as account_type,
            try_cast(balance as decimal(18,2)) as balance,
            try_cast(available_balance as decimal(18,2)) as available_balance,
            upper(trim(currency)) as currency,
            try_cast(interest_rate as decimal(8,4)) as interest_rate,
            {d('opened_date')} as opened_date,
            cast({TODAY} - {d('opened_date')} as integer) as account_age_days,
            upper(trim(status)) as status, trim(branch_code) as branch_code,
            coalesce(try_cast(balance as decimal(18,2)) < 0, false) as is_overdrawn,
            {ts('created_at')} as created_at, {ts('updated_at')} as updated_at,
            _source_file, _batch_id""",
    "transactions": f"""
        select trim(transaction_id) as transaction_id, trim(account_id) as account_id,
            trim(customer_id) as customer_id,
            upper(trim(transaction_type)) as transaction_type,
            try_cast(amount as decimal(18,2)) as amount,
            abs(try_cast(amount as decimal(18,2))) as amount_abs,
            coalesce(try_cast(amount as decimal(18,2)) < 0, false) as is_debit,
            coalesce(try_cast(amount as decimal(18,2)) > 0, false) as is_credit,
            upper(trim(currency)) as currency,
            try_cast(balance_after as decimal(18,2)) as balance_after,
            trim(description) as description,
            {words('merchant_name')} as merchant_name,
            upper(trim(merchant_category)) as merchant_category,
            upper(trim(channel)) as channel, upper(trim(status)) as status,
            {ts('transaction_date')} as transaction_date,
            {yyyymmdd(d('transaction_date'))} as transaction_date_key,
            {d('value_date')} as value_date, trim(reference_number) as reference_number,
            {ts('created_at')} as created_at, _source_file, _batch_id""",
    "fraud_flags": f"""
        select trim(flag_id) as flag_id, trim(transaction_id) as transaction_id,
            trim(account_id) as account_id, trim(customer_id) as customer_id,
            trim(flag_reason) as flag_reason, upper(trim(severity)) as severity,
            case upper(trim(severity)) when 'CRITICAL' then 4 when 'HIGH' then 3
                 when 'MEDIUM' then 2 when 'LOW' then 1 else 0 end as severity_rank,
            try_cast(fraud_score as decimal(8,4)) as fraud_score,
            coalesce(upper(trim(is_confirmed_fraud)) = 'TRUE', false) as is_confirmed_fraud,
            {ts('flagged_at')} as flagged_at, {ts('reviewed_at')} as reviewed_at,
            trim(reviewed_by) as reviewed_by,
            cast(cast(coalesce({ts('reviewed_at')}, {NOW}) as date)
                 - cast({ts('flagged_at')} as date) as integer) as days_to_review,
            {ts('created_at')} as created_at, _source_file, _batch_id""",
}

RELATIONS: dict[str, str] = {}

for _e in ENTITIES:
    RELATIONS[f"raw_{_e}"] = raw_sql(_e, "duckdb")
    RELATIONS[f"next_{_e}"] = next_batch_sql(_e, "duckdb")
    RELATIONS[f"both_{_e}"] = (
        f"select * from raw_{_e} union all by name select * from next_{_e}"
    )
    # Silver holds all deliveries; its state after the first one starts the history.
    for _silver, _raw in ((f"silver_{_e}", f"both_{_e}"), (f"silver1_{_e}", f"raw_{_e}")):
        RELATIONS[_silver] = (
            f"select *, {_verdict(_e)}, {NOW} as _silver_loaded_at "
            f"from ({_CLEAN[_e]} from ({_latest(_e, _raw)}))"
        )

_CUSTOMER_DIM = f"""
    customer_id, first_name, last_name, full_name, email, city, state, country,
    customer_since, tenure_days, {duration_band('tenure_days')} as tenure_band,
    age_years, {age_band('age_years')} as age_band, status, credit_score, credit_tier,
    coalesce(status = 'ACTIVE', false) as is_active, _silver_loaded_at
"""

RELATIONS["dim_date"] = f"""
    select {yyyymmdd('day')} as date_key, day as full_date,
        cast(dayofweek(day) as integer) as day_of_week, left(dayname(day), 3) as day_name,
        cast(day(day) as integer) as day_of_month,
        cast(dayofyear(day) as integer) as day_of_year,
        cast(weekofyear(day) as integer) as week_of_year,
        cast(month(day) as integer) as month_number, left(monthname(day), 3) as month_name,
        left(monthname(day), 3) as month_short,
        cast(quarter(day) as integer) as quarter_number,
        'Q' || quarter(day) as quarter_name, cast(year(day) as integer) as year_number,
        dayofweek(day) in (0, 6) as is_weekend,
        dayofweek(day) not in (0, 6) as is_weekday, day(day) = 1 as is_month_start,
        day = last_day(day) as is_month_end,
        day = cast(date_trunc('quarter', day) as date) as is_quarter_start,
        day = cast(date_trunc('quarter', day) + interval 3 month - interval 1 day as date)
            as is_quarter_end,
        {NOW} as _gold_loaded_at
    from (select date '2020-01-01' + cast(i as integer) as day from range(2922) as r(i))
"""
RELATIONS["dim_customers"] = f"""
    select {dense('customer_key', 'customer_id')}, *, {NOW} as _gold_loaded_at
    from (select {_CUSTOMER_DIM} from silver_customers where dq_is_valid)
"""
RELATIONS["dim_customers_first"] = RELATIONS["dim_customers"].replace("silver_customers", "silver1_customers")
RELATIONS["dim_accounts"] = f"""
    select {dense('account_key', 'account_id')}, account_id, customer_id, account_number,
        account_type,
        case account_type when 'CHECKING' then 'Checking Account'
            when 'SAVINGS' then 'Savings Account' when 'LOAN' then 'Loan Account'
            when 'CREDIT' then 'Credit Card Account' else 'Unknown' end as account_type_desc,
        currency, interest_rate, opened_date, account_age_days,
        {duration_band('account_age_days')} as account_age_band, status, branch_code,
        is_overdrawn, coalesce(status = 'ACTIVE', false) as is_active,
        _silver_loaded_at, {NOW} as _gold_loaded_at
    from silver_accounts where dq_is_valid
"""
RELATIONS["fact_transactions"] = f"""
    select {dense('transaction_key', 't.transaction_id')}, t.transaction_id,
        a.account_key, c.customer_key, dd.date_key, t.account_id, t.customer_id,
        t.transaction_type, t.amount, t.amount_abs, t.is_debit, t.is_credit, t.currency,
        t.balance_after, t.merchant_name, t.merchant_category, t.channel, t.status,
        t.transaction_date, t.value_date, t.reference_number,
        exists (select 1 from silver_fraud_flags f
                where f.dq_is_valid and f.transaction_id = t.transaction_id)
            as is_fraud_flagged,
        {NOW} as _gold_loaded_at
    from silver_transactions t
    left join dim_accounts a using (account_id)
    left join dim_customers c on c.customer_id = t.customer_id
    left join dim_date dd on dd.date_key = t.transaction_date_key
    where t.dq_is_valid
"""
RELATIONS["fact_fraud"] = f"""
    select {dense('fraud_key', 'f.flag_id')}, f.flag_id, t.transaction_key, a.account_key,
        c.customer_key, dd.date_key, f.transaction_id, f.account_id, f.customer_id,
        f.flag_reason, f.severity, f.severity_rank, f.fraud_score,
        case when f.fraud_score >= 0.9 then 'CRITICAL' when f.fraud_score >= 0.7 then 'HIGH'
             when f.fraud_score >= 0.5 then 'MEDIUM' else 'LOW' end as fraud_score_band,
        f.is_confirmed_fraud, f.flagged_at, f.reviewed_at, f.days_to_review,
        coalesce(f.days_to_review <= 3, false) as review_sla_met,
        {NOW} as _gold_loaded_at
    from silver_fraud_flags f
    left join fact_transactions t on t.transaction_id = f.transaction_id
    left join dim_accounts a on a.account_id = f.account_id
    left join dim_customers c on c.customer_id = f.customer_id
    left join dim_date dd on dd.date_key = {yyyymmdd('f.flagged_at')}
    where f.dq_is_valid
"""

# ---- rejects --------------------------------------------------------------
_REJECT_IDS = {
    "customers": "cast(null as varchar) as account_id, "
                 "cast(null as varchar) as transaction_id, customer_id",
    "accounts": "account_id, cast(null as varchar) as transaction_id, customer_id",
    "transactions": "account_id, transaction_id, customer_id",
    "fraud_flags": "account_id, transaction_id, customer_id",
}
for _e in ENTITIES:
    _severity = "CRITICAL" if _e in ("transactions", "fraud_flags") else "HIGH"
    RELATIONS[f"rejects_{_e}"] = f"""
        select 'REJ_{STAMP}_' || coalesce({BUSINESS_KEY[_e]}, 'NULL_' || md5(concat_ws('|',
                '{_e}', _batch_id, _source_file, dq_issues))) as reject_id,
            'SILVER_{_e.upper()}' as source_table, 'SILVER' as source_layer,
            _batch_id as batch_id, '{_e}' as entity,
            coalesce(dq_issues, 'Unknown DQ failure') as reject_reason,
            'DQ_SILVER_{_e.upper()}' as reject_rule, '{_severity}' as severity,
            {_REJECT_IDS[_e]}, {NOW} as rejected_at,
            'bronze_to_silver_dag' as pipeline_name
        from silver_{_e} where not dq_is_valid
    """
RELATIONS["reject_records"] = " union all by name ".join(
    f"select * from rejects_{e}" for e in ENTITIES
)
for _e in ENTITIES:
    _key = BUSINESS_KEY[_e]
    _ties = ", ".join(f"{c} desc nulls last" for c in SOURCE_COLUMNS[_e] if c != _key)
    RELATIONS[f"duplicates_{_e}"] = f"""
        select 'RAW_{_e.upper()}' as source_table, '{_e}' as entity,
            trim({_key}) as business_id, _batch_id as batch_id,
            _load_timestamp as load_timestamp, _source_file as source_file,
            'DUPLICATE_KEY' as reason_code, {NOW} as rejected_at
        from both_{_e}
        qualify row_number() over (partition by {_key} order by
            _load_timestamp desc nulls first, _source_file desc nulls last, {_ties}) > 1
    """

# ---- customer history -----------------------------------------------------
HASH = (
    "md5(coalesce(status, '') || '|' || coalesce(cast(credit_score as varchar), '') || '|' "
    "|| coalesce(credit_tier, '') || '|' || coalesce(city, '') || '|' || coalesce(state, ''))"
)
RELATIONS["dim_first"] = f"""
    select *, date '2024-01-01' as effective_from, date '9999-12-31' as effective_to,
        true as is_current, {HASH} as record_hash
    from dim_customers_first
"""
RELATIONS["history_changes"] = f"""
    select n.*, o.record_hash as old_hash, o.customer_key as existing_key,
        case when o.customer_id is null then 'NEW'
             when o.record_hash <> n.new_hash then 'CHANGED'
             else 'UNCHANGED' end as change_type
    from (select {_CUSTOMER_DIM}, {HASH} as new_hash from silver_customers
          where dq_is_valid) n
    left join dim_first o on o.customer_id = n.customer_id and o.is_current
"""
RELATIONS["history_expired"] = f"""
    select * replace (
        case when customer_id in (select customer_id from history_changes
                                  where change_type = 'CHANGED')
             then {TODAY} - 1 else effective_to end as effective_to,
        customer_id not in (select customer_id from history_changes
                            where change_type = 'CHANGED') as is_current)
    from dim_first
"""
RELATIONS["history_inserted"] = f"""
    select (select max(customer_key) from dim_first)
            + row_number() over (order by md5(customer_id), customer_id) as customer_key,
        * exclude (new_hash, old_hash, existing_key, change_type),
        {NOW} as _gold_loaded_at, {TODAY} as effective_from,
        date '9999-12-31' as effective_to, true as is_current, new_hash as record_hash
    from history_changes where change_type in ('NEW', 'CHANGED')
"""
RELATIONS["history"] = (
    "select * from history_expired union all by name select * from history_inserted"
)
RELATIONS["history_counts"] = """
    select count(*) filter (where change_type in ('NEW', 'CHANGED')) as rows_inserted,
        count(*) filter (where change_type = 'CHANGED') as rows_expired,
        count(*) filter (where change_type = 'UNCHANGED') as rows_unchanged
    from history_changes
"""

# A run of the history inside the dates of the facts.
_MIDDLE = "date '2025-06-30'"
for _name in ("history_expired", "history_inserted", "history"):
    RELATIONS[f"{_name}_middle"] = (
        RELATIONS[_name].replace(TODAY, _MIDDLE).replace(NOW, "timestamp '2025-06-30 00:00:00'")
        .replace("history_expired", "history_expired_middle")
        .replace("history_inserted", "history_inserted_middle")
    )

# ---- keys that last -----------------------------------------------------------
for _e, _id in (("accounts", "account"), ("transactions", "transaction"), ("fraud_flags", "flag")):
    RELATIONS[f"lasting_{_e}"] = f"""
        with before as (select {_id}_id, {dense('k', f'{_id}_id')} from silver1_{_e} where dq_is_valid)
        select n.{_id}_id, coalesce(b.k, (select max(k) from before) + row_number() over (
            partition by b.k is null order by md5(n.{_id}_id), n.{_id}_id)) as {_id}_key
        from (select {_id}_id from silver_{_e} where dq_is_valid) n
        left join before b using ({_id}_id)
    """
RELATIONS["fact_over_history"] = """
    select t.transaction_id, k.transaction_key, a.account_key, c.customer_key
    from silver_transactions t
    join lasting_transactions k on k.transaction_id = t.transaction_id
    left join lasting_accounts a on a.account_id = t.account_id
    left join (select customer_id, customer_key from history where is_current) c
      on c.customer_id = t.customer_id
    where t.dq_is_valid
"""

# ---- ledger -----------------------------------------------------------------
RELATIONS["balance_breaks"] = """
    select * from (
        select account_id, transaction_id, amount, balance_after, _batch_id,
            cast(lag(balance_after) over (partition by account_id
                order by transaction_date, transaction_id) + amount as decimal(18,2))
                as expected_balance
        from silver_transactions where dq_is_valid)
    where balance_after <> expected_balance
"""

_NAME = re.compile(r"\b[a-z][a-z0-9_]*\b")


def with_relations(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the relations a query mentions, directly or through others."""
    known = {**RELATIONS, **(extra or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in known and name not in ordered and known[name] is not sql:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(query)
    if not ordered:
        return query.strip()
    ctes = ",\n".join(f"{n} as materialized ({known[n].strip()})" for n in ordered)
    return f"with {ctes}\n{query.strip()}"
