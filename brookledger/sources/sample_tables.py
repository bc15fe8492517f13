"""Bronze rows derived from the TPC-H-like sample tables.

The SQL here runs unchanged in Spark and in DuckDB, so both sides of the
correctness check start from the same rows. Most rows are as the contracts
want them; each rule is broken by some: missing keys and emails, unreadable
dates and amounts, values outside their domain, accounts that do not exist,
mixed case and stray blanks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import BUSINESS_KEY, LINEAGE_COLUMNS, SOURCE_COLUMNS

_LINEAGE = """
    'raw/{entity}/year=2024/month=01/day=01/{entity}.csv' as _source_file,
    '{entity}' as _source_entity,
    cast('2024-01-01 00:00:00' as {timestamp}) as _load_timestamp,
    'BATCH_20240101' as _batch_id,
    cast(null as {string}) as _checksum
"""

_CUSTOMERS = """
select
    case when c_custkey % 211 = 7 then null
         else concat('CUST', lpad(cast(c_custkey as {string}), 9, '0')) end as customer_id,
    case when c_custkey % 137 = 6 then ''
         else case c_custkey % 5 when 0 then ' oskar ' when 1 then 'NADIA' when 2 then 'tove'
              when 3 then 'Ruben' else 'ilse ' end end as first_name,
    case when c_custkey % 139 = 6 then null else lower(c_mktsegment) end as last_name,
    case when c_custkey % 37 = 3 then null
         when c_custkey % 41 = 5 then 'no-at-sign'
         else concat(' User', cast(c_custkey as {string}), '@Email.com') end as email,
    concat('+1', cast(2000000000 + c_custkey as {string})) as phone,
    case when c_custkey % 53 = 11 then 'N/A'
         else cast(date '1950-01-01' + cast(c_custkey * 37 % 18628 as int) as {string})
         end as date_of_birth,
    concat(cast(c_custkey % 9999 + 1 as {string}), ' Main St') as address_line1,
    cast(null as {string}) as address_line2,
    lower(n_name) as city,
    case when c_custkey % 127 = 9 then 'Calif' else
         case n_regionkey when 0 then 'ca' when 1 then 'ny' when 2 then 'tx' when 3 then 'fl'
         else 'wa' end end as state,
    cast(10000 + c_custkey % 89999 as {string}) as zip_code,
    case when c_custkey % 131 = 9 then 'usa' when c_custkey % 43 = 8 then null else 'us' end
         as country,
    case when c_custkey % 109 = 9 then 'soon'
         else cast(date '2010-01-01' + cast(c_custkey * 13 % 5000 as int) as {string})
         end as customer_since,
    case when c_custkey % 67 = 9 then null
         when c_custkey % 101 = 2 then 'unknown'
         when c_custkey % 23 = 4 then 'active'
         when c_custkey % 20 < 17 then 'ACTIVE'
         when c_custkey % 20 < 19 then 'INACTIVE'
         else 'SUSPENDED' end as status,
    case when c_custkey % 71 = 4 then 'bad'
         when c_custkey % 89 = 1 then '900'
         else cast(580 + c_custkey % 271 as {string}) end as credit_score,
    '2024-01-01 00:00:00.123456+00:00' as created_at,
    '2024-01-01 00:00:00.123456+00:00' as updated_at,
    {lineage}
from {customer} join {nation} on c_nationkey = n_nationkey
"""

_ACCOUNTS = """
select
    case when c_custkey % 211 = 7 then null
         else concat('ACC', lpad(cast(c_custkey * 3 + i as {string}), 10, '0')) end
        as account_id,
    case when c_custkey % 139 = 8 then null
         else concat('CUST', lpad(cast(c_custkey as {string}), 9, '0')) end as customer_id,
    case when c_custkey % 137 = 9 then null
         else concat('****', lpad(cast((c_custkey * 7 + i) % 10000 as {string}), 4, '0')) end
        as account_number,
    case when c_custkey % 29 = 4 then lower(t) when c_custkey % 61 = 5 then 'PENSION'
         when c_custkey % 149 = 10 then null else t end as account_type,
    case when c_custkey % 97 = 11 then 'n/a' when c_custkey % 73 = 12 then null
         else cast(cast(c_acctbal as decimal(18,2)) as {string}) end as balance,
    case when c_custkey % 101 = 12 then 'n/a'
         else cast(cast(c_acctbal as decimal(18,2)) as {string}) end as available_balance,
    case when c_custkey % 103 = 13 then 'dollar' when c_custkey % 31 = 14 then null
         else 'USD' end as currency,
    case when c_custkey % 107 = 14 then '-0.01'
         else case i when 0 then '0.01' when 1 then '0.0425' else '0.1199' end end
        as interest_rate,
    case when c_custkey % 109 = 15 then 'soon'
         else cast(date '2012-01-01' + cast(c_custkey * 11 % 4300 as int) as {string}) end
        as opened_date,
    case when c_custkey % 20 < 17 then 'ACTIVE' else 'INACTIVE' end as status,
    case when c_custkey % 113 = 16 then null
         else concat('BR', lpad(cast(c_nationkey % 10 + 1 as {string}), 3, '0')) end
        as branch_code,
    case when c_custkey % 127 = 17 then 'never'
         else '2024-01-01 00:00:00.123456+00:00' end as created_at,
    case when c_custkey % 131 = 18 then 'never'
         else '2024-01-01 00:00:00.123456+00:00' end as updated_at,
    {lineage}
from (
    select *, 0 as i, 'CHECKING' as t from {customer}
    union all select *, 1 as i, 'SAVINGS' as t from {customer} where c_custkey % 3 >= 1
    union all select *, 2 as i, 'LOAN' as t from {customer} where c_custkey % 3 = 2
) as held
"""

_TRANSACTION_ACCOUNT = """
    case when o_orderkey % 113 = 5 then 'ACC_ORPHAN' when o_orderkey % 263 = 6 then null
         else concat('ACC', lpad(cast(o_custkey * 3 as {string}), 10, '0')) end as account_id,
    case when o_orderkey % 257 = 7 then null
         else concat('CUST', lpad(cast(o_custkey as {string}), 9, '0')) end as customer_id,
"""

# The balance is what the amounts of the customer's checking account add up to;
# some are written down wrong.
_TRANSACTIONS = """
select
    case when o_orderkey % 251 = 8 then null
         else concat('TXN', lpad(cast(o_orderkey as {string}), 12, '0')) end as transaction_id,
    {account}
    case when o_orderkey % 59 = 9 then 'refund' when o_orderkey % 61 = 9 then 'deposit'
         when o_orderkey % 4 = 0 then 'DEPOSIT' when o_orderkey % 4 = 1 then 'WITHDRAWAL'
         when o_orderkey % 4 = 2 then 'PAYMENT' else 'FEE' end as transaction_type,
    case when o_orderkey % 97 = 3 then 'n/a' else cast(moved as {string}) end as amount,
    case when o_orderkey % 241 = 10 then 'dollar' when o_orderkey % 47 = 11 then null
         else 'USD' end as currency,
    case when o_orderkey % 239 = 11 then 'n/a'
         when o_orderkey % 149 = 4 then cast(reached + 1 as {string})
         else cast(reached as {string}) end as balance_after,
    case when o_orderkey % 233 = 12 then repeat('long ', 50)
         else concat(' order ', cast(o_orderkey as {string}), ' ') end as description,
    case when o_orderkey % 4 = 0 then null when o_orderkey % 229 = 13 then repeat('shop ', 30)
         else 'corner bakery' end as merchant_name,
    case when o_orderkey % 4 = 0 then null when o_orderkey % 227 = 14 then repeat('goods ', 10)
         else 'bakery' end as merchant_category,
    case when o_orderkey % 223 = 15 then null when o_orderkey % 71 = 16 then 'fax'
         else case o_orderkey % 5 when 0 then 'ATM' when 1 then 'online' when 2 then 'MOBILE'
         when 3 then 'BRANCH' else 'POS' end end as channel,
    case when o_orderkey % 53 = 17 then null when o_orderkey % 199 = 18 then 'lost'
         else case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'PENDING'
         else 'FAILED' end end as status,
    case when o_orderkey % 131 = 6 then 'not a date' when o_orderkey % 197 = 19 then null
         else cast(o_orderdate + interval '26' year as {string}) end as transaction_date,
    case when o_orderkey % 193 = 20 then 'later'
         else cast(cast(o_orderdate + interval '26' year as date) as {string}) end as value_date,
    case when o_orderkey % 191 = 21 then null
         else concat('REF', cast(o_orderkey as {string})) end as reference_number,
    case when o_orderkey % 181 = 22 then 'never'
         else '2024-01-01 00:00:00.123456+00:00' end as created_at,
    {lineage}
from (
    select *, cast(sum(moved) over (
        partition by o_custkey order by o_orderdate, o_orderkey
        rows between unbounded preceding and current row) as decimal(18,2)) as reached
    from (
        select *, cast(case when o_orderkey % 173 = 9 then 0
                            when o_orderkey % 4 = 0 then o_totalprice else -o_totalprice end
                       as decimal(18,2)) as moved
        from {orders}
    ) as m
) as r
"""

_FRAUD_FLAGS = """
select
    case when o_orderkey % 511 = 7 then null
         else concat('FLG', lpad(cast(o_orderkey as {string}), 12, '0')) end as flag_id,
    case when o_orderkey % 497 = 14 then null
         else concat('TXN', lpad(cast(o_orderkey as {string}), 12, '0')) end as transaction_id,
    {account}
    case when o_orderkey % 469 = 21 then null else ' Unusual pattern of spending ' end
        as flag_reason,
    case when o_orderkey % 35 = 28 then 'medium' else
         case o_orderpriority when '1-URGENT' then 'CRITICAL' when '2-HIGH' then 'HIGH'
         when '3-MEDIUM' then 'MEDIUM' when '5-LOW' then 'LOW' else 'unspecified' end end
         as severity,
    case when o_orderkey % 139 = 0 then null when o_orderkey % 203 = 35 then '1.5'
         when o_orderkey % 217 = 42 then 'high'
         else concat('0.', lpad(cast(o_orderkey % 1000 as {string}), 3, '0')) end
         as fraud_score,
    case when o_orderkey % 427 = 49 then 'maybe' when o_orderkey % 77 = 56 then null
         when o_orderkey % 10 = 0 then 'True' else 'False' end as is_confirmed_fraud,
    case when o_orderkey % 413 = 63 then 'just now'
         else cast(o_orderdate + interval '26' year + interval '6' hour as {string}) end
         as flagged_at,
    case when o_orderkey % 371 = 70 then 'soon'
         when o_orderkey % 3 = 0 then null
         when o_orderkey % 3 = 1
         then cast(o_orderdate + interval '26' year + interval '30' hour as {string})
         else cast(o_orderdate + interval '26' year + interval '130' hour as {string}) end
         as reviewed_at,
    case when o_orderkey % 3 = 0 then null else 'analyst' end as reviewed_by,
    case when o_orderkey % 329 = 77 then 'never'
         else '2024-01-01 00:00:00.123456+00:00' end as created_at,
    {lineage}
from {orders}
where o_orderkey % 7 = 0
"""

_TEMPLATES = {
    "customers": _CUSTOMERS,
    "accounts": _ACCOUNTS,
    "transactions": _TRANSACTIONS,
    "fraud_flags": _FRAUD_FLAGS,
}
# Declared, so that no job has to look into the files for their columns.
_SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
}
_TABLES = {
    "customers": ["customer", "nation"],
    "accounts": ["customer"],
    "transactions": ["orders"],
    "fraud_flags": ["orders"],
}

# The next day's delivery: some rows change (kind 0), some repeat word for word
# (1), rows without a key among them, and some are new (2). Of a part of the
# changed ones a second row comes in the same file, so that they tie.
_KINDS = """
    select *, case when {key} is null then 1 when number % {every} = 0 then 0
                   when number % {every} = {step} then 1
                   when number % {rare} = 2 * {step} then 2 end as kind
    from (select *, {number} as number from ({first_batch}) as b) as n
"""
_NEXT_DAY = """
select {fresh_key}, {same}, {changed}, {lineage} from ({kinds}) as k where kind is not null
union all
select {fresh_key}, {same}, {tied}, {lineage} from ({kinds}) as k
where kind = 0 and number % (3 * {every}) = 0
"""
#: Entity -> number of a row, how often rows change and are new, the first step, the columns
#: that change, and what they become in the row that changed and in the one that ties with it.
_CHANGES = {
    "customers": (
        "cast(substr(phone, 3) as bigint) - 2000000000", 10, 50, 1,
        {"status": ("case when kind = 0 then 'SUSPENDED' else status end", "'INACTIVE'"),
         "credit_score": (
             "case when kind = 0 and credit_score not in ('bad', '900') "
             "then cast(cast(credit_score as int) + 5 as {string}) else credit_score end",
             "'700'")},
    ),
    "accounts": (
        "cast(substr(account_id, 4) as bigint)", 10, 50, 1,
        {"balance": ("case when kind = 0 then '12.34' else balance end", "'99.99'"),
         "status": ("case when kind = 0 then 'INACTIVE' else status end", "'ACTIVE'")},
    ),
    "transactions": (
        "cast(substr(transaction_id, 4) as bigint)", 50, 150, 10,
        {"status": ("case when kind = 0 then 'REVERSED' else status end", "'COMPLETED'")},
    ),
    "fraud_flags": (
        "cast(substr(flag_id, 4) as bigint)", 70, 210, 7,
        {"severity": ("case when kind = 0 then 'CRITICAL' else severity end", "'LOW'"),
         "is_confirmed_fraud": (
             "case when kind = 0 then 'True' else is_confirmed_fraud end", "'False'")},
    ),
}
_KEY_DIGITS = {"customers": ("CUST", 9), "accounts": ("ACC", 10), "transactions": ("TXN", 12), "fraud_flags": ("FLG", 12)}
_NEW_FROM = 100_000_000


def raw_sql(entity: str, dialect: str = "spark", *, tables: dict[str, str] | None = None) -> str:
    """SQL text of an entity's first Bronze batch."""
    names = tables or {t: t for t in ("customer", "nation", "orders")}
    words = _words(dialect)
    return _TEMPLATES[entity].format(
        lineage=_LINEAGE.format(entity=entity, **words).strip(),
        account=_TRANSACTION_ACCOUNT.format(**words).strip(),
        **words,
        **names,
    )


def next_batch_sql(
    entity: str, dialect: str = "spark", *, tables: dict[str, str] | None = None
) -> str:
    """SQL text of the following day's batch."""
    words = _words(dialect)
    lineage = (
        _LINEAGE.format(entity=entity, **words)
        .strip()
        .replace("day=01/", "day=02/")
        .replace("2024-01-01", "2024-01-02")
        .replace("20240101", "20240102")
    )
    number, every, rare, step, changes = _CHANGES[entity]
    key, (head, digits) = BUSINESS_KEY[entity], _KEY_DIGITS[entity]
    kinds = _KINDS.format(
        key=key, number=number, every=every, rare=rare, step=step,
        first_batch=raw_sql(entity, dialect, tables=tables),
    )
    own = {key, *changes}
    return _NEXT_DAY.format(
        fresh_key=f"case when kind = 2 then concat('{head}', lpad(cast(number + {_NEW_FROM} "
        f"as {words['string']}), {digits}, '0')) else {key} end as {key}",
        same=", ".join(c for c in SOURCE_COLUMNS[entity] if c not in own),
        changed=", ".join(f"{to.format(**words)} as {c}" for c, (to, _) in changes.items()),
        tied=", ".join(f"{to} as {c}" for c, (_, to) in changes.items()),
        kinds=kinds, every=every, lineage=lineage,
    )


def _words(dialect: str) -> dict[str, str]:
    return {
        "string": "string" if dialect == "spark" else "varchar",
        "timestamp": "timestamp_ntz" if dialect == "spark" else "timestamp",
    }


class SampleBronze:
    """Bronze tables of a sample directory, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(_SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def _run(self, sql: str, entity: str) -> DataFrame:
        frames = {t: self.table(t) for t in _TABLES[entity]}
        columns = SOURCE_COLUMNS[entity] + LINEAGE_COLUMNS
        return self.spark.sql(sql, **frames).select(*columns)

    def first(self, entity: str) -> DataFrame:
        marks = {t: "{" + t + "}" for t in ("customer", "nation", "orders")}
        return self._run(raw_sql(entity, tables=marks), entity)

    def following(self, entity: str) -> DataFrame:
        """The next day's batch."""
        marks = {t: "{" + t + "}" for t in ("customer", "nation", "orders")}
        return self._run(next_batch_sql(entity, tables=marks), entity)

    def both(self, entity: str) -> DataFrame:
        return self.first(entity).unionByName(self.following(entity))

    def numbers(self, count_of: str, column: str) -> DataFrame:
        return self.table(count_of).select(F.col(column).alias("n"))
