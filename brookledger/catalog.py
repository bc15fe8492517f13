"""Every query by name: (session, directory of sample tables) -> DataFrame."""

from __future__ import annotations

import contextlib
import datetime as dt
import posixpath
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import ENTITIES, LANDING_MAX_MB, SOURCE_COLUMNS
from brookledger.functions.calendar import compact_stamp
from brookledger.operators import ledger
from brookledger.operators.dedup import latest_per_key, roll_forward
from brookledger.plans import (
    audit,
    contracts,
    daily_batch,
    fact_delta,
    gold,
    history_store,
    quality,
    quality_state,
    rejects,
    reports,
    scd2,
    verify,
)
from brookledger.plans.rule_catalogue import (
    BRONZE_RULES,
    GOLD_CHECKS,
    GOLD_RULES,
    SILVER_CHECKS,
    SILVER_RULES,
)
from brookledger.plans.silver import clean_silver, to_silver
from brookledger.settings import DEFAULT_AS_OF as AS_OF
from brookledger.sources import bronze, csv_records, landing, snapshots
from brookledger.sources.sample_tables import SampleBronze
from brookledger.sources.tables import new_folder, publish, stage, stage_all
from brookledger.sources.tables import required_tables as tables_present
from brookledger.streaming.incremental import ingest_new_files

#: Rows of a file in the queries on versioned tables, so that the smallest sample is some files.
SAMPLE_ROWS_PER_FILE = 50_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# ---- inputs shared by the queries -----------------------------------------
def silver(spark: SparkSession, sf_dir: str, *entities: str) -> dict[str, DataFrame]:
    """Silver tables over all deliveries, as plans read once by whoever uses them."""
    sample = SampleBronze(spark, sf_dir)
    return {e: to_silver(sample.both(e), e, AS_OF) for e in entities or ENTITIES}


def stored_silver(spark: SparkSession, sf_dir: str, *entities: str) -> dict[str, DataFrame]:
    """Silver tables written out, as a job that reads them twice needs them."""
    return stage_all(silver(spark, sf_dir, *entities), "silver")


# ---- Silver ---------------------------------------------------------------
@query("silver_customers_rolled_forward")
def silver_customers_rolled_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after the second delivery, from the first day's survivors and it."""
    sample = SampleBronze(spark, sf_dir)
    survivors = latest_per_key(sample.first("customers"), "customers")
    rolled = roll_forward(
        stage(survivors, "latest-customers"), sample.following("customers"), "customers"
    )
    return clean_silver(rolled, "customers", AS_OF)


def _silver_query(entity: str) -> None:
    @query(f"silver_{entity}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver(spark, sf_dir, entity)[entity]


for _entity in ENTITIES:
    _silver_query(_entity)


# ---- rejects --------------------------------------------------------------
def _reject_query(entity: str) -> None:
    @query(f"rejects_{entity}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rejects.invalid_rows(silver(spark, sf_dir, entity)[entity], entity, AS_OF)


for _entity in ENTITIES:
    _reject_query(_entity)


@query("reject_records")
def reject_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.all_invalid_rows(silver(spark, sf_dir), AS_OF)


@query("reject_summary")
def reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.summary(reject_records(spark, sf_dir))


@query("latest_rejects")
def latest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.latest(reject_records(spark, sf_dir))


@query("duplicate_rejects")
def duplicate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = SampleBronze(spark, sf_dir)
    return rejects.all_duplicates(stage_all({e: sample.both(e) for e in ENTITIES}, "bronze"), AS_OF)


# ---- Gold -----------------------------------------------------------------
@query("dim_customers")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, sf_dir, "customers")
    return gold.dim_customers(stored["customers"], AS_OF)


@query("dim_accounts")
def dim_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, sf_dir, "accounts")
    return gold.dim_accounts(stored["accounts"], AS_OF)


@query("fact_transactions")
def fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, sf_dir)
    return gold.fact_transactions(
        stored["transactions"],
        stored["fraud_flags"],
        gold.dim_accounts(stored["accounts"], AS_OF),
        gold.dim_customers(stored["customers"], AS_OF),
        gold.dim_date(spark, AS_OF),
        AS_OF,
    )


@query("fact_transactions_over_history")
def fact_transactions_over_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the fact after the second delivery.

    Facts and accounts of the first delivery keep their keys, and customers
    resolve to the current version in the history dimension.
    """
    sample, stored = SampleBronze(spark, sf_dir), stored_silver(spark, sf_dir)
    before = stage_all(
        {e: to_silver(sample.first(e), e, AS_OF) for e in ("accounts", "transactions")}, "silver"
    )
    fact = gold.fact_transactions(
        stored["transactions"],
        stored["fraud_flags"],
        gold.dim_accounts(
            stored["accounts"], AS_OF,
            stage(gold.dim_accounts(before["accounts"], AS_OF), "dim-accounts"),
        ),
        stage(_history(spark, sf_dir)[1].dimension, "dim-customers"),
        gold.dim_date(spark, AS_OF),
        AS_OF,
        known=stage(gold.transaction_keys(before["transactions"]), "known-keys"),
    )
    return fact.select("transaction_id", "transaction_key", "account_key", "customer_key")


def _facts_by_changes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both facts built from the first delivery and brought to the second by its changes alone.

    Tables are staged one after the other: each of these jobs has work for all
    executors, and the driver plans and compiles for one at a time.
    """
    sample, root = SampleBronze(spark, sf_dir), new_folder(spark, "facts")
    first = {e: stage(to_silver(sample.first(e), e, AS_OF), f"first-{e}") for e in ENTITIES}
    second = {e: stage(df, f"second-{e}") for e, df in silver(spark, sf_dir, "accounts", "customers", "fraud_flags").items()}
    calendar = gold.dim_date(spark, AS_OF)
    before = {
        "dim_accounts": stage(gold.dim_accounts(first["accounts"], AS_OF), "dim-accounts-first"),
        "dim_customers": stage(scd2.bootstrap(gold.dim_customers(first["customers"], AS_OF), AS_OF), "dim-customers-first"),
    }
    after = {
        "dim_accounts": stage(gold.dim_accounts(second["accounts"], AS_OF, before["dim_accounts"]), "dim-accounts-second"),
        "dim_customers": stage(
            scd2.apply_history(before["dim_customers"], second["customers"], AS_OF).dimension, "dim-customers-second"),
    }
    dims = (before["dim_accounts"], before["dim_customers"], calendar)
    transactions = stage(gold.fact_transactions(first["transactions"], first["fraud_flags"], *dims, AS_OF), "fact-first")
    fraud = stage(gold.fact_fraud(first["fraud_flags"], transactions, *dims, AS_OF), "fraud-first")
    states = {
        name: fact_delta.create(spark, root, name, fact, rows_per_file=SAMPLE_ROWS_PER_FILE)
        for name, fact in ((fact_delta.TRANSACTIONS, transactions), (fact_delta.FRAUD, fraud))
    }
    snapshots.commit(spark, root, snapshots.EMPTY, states)
    delivered = {e: to_silver(sample.following(e), e, AS_OF) for e in ("transactions", "fraud_flags")}
    version, _ = fact_delta.run_day(
        spark, root, delivered, second, before, after, calendar, AS_OF, rows_per_file=SAMPLE_ROWS_PER_FILE)
    return {name: snapshots.read(spark, version, name) for name in states}


@query("fact_transactions_by_changes")
def fact_transactions_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts_by_changes(spark, sf_dir)[fact_delta.TRANSACTIONS]


@query("fact_fraud_by_changes")
def fact_fraud_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts_by_changes(spark, sf_dir)[fact_delta.FRAUD]


@query("fact_fraud")
def fact_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, sf_dir)
    return gold.fact_fraud(
        stored["fraud_flags"],
        gold.transaction_keys(stored["transactions"]),
        gold.dim_accounts(stored["accounts"], AS_OF),
        gold.dim_customers(stored["customers"], AS_OF),
        gold.dim_date(spark, AS_OF),
        AS_OF,
    )


@query("dim_date_activity")
def dim_date_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with the valid transactions and flags of each day."""
    tables = silver(spark, sf_dir, "transactions", "fraud_flags")
    return reports.calendar_activity(
        gold.dim_date(spark, AS_OF), tables["transactions"], tables["fraud_flags"]
    )


def star(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Silver and Gold tables, both written out."""
    stored = stored_silver(spark, sf_dir)
    return stored, daily_batch.store_gold(
        stored, AS_OF, new_folder(spark, "gold")
    )


# ---- verification ---------------------------------------------------------
@query("bronze_row_counts")
def bronze_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = SampleBronze(spark, sf_dir)
    return verify.row_counts({f"RAW_{e.upper()}": sample.both(e) for e in ENTITIES})


@query("bronze_batches")
def bronze_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.batches(SampleBronze(spark, sf_dir).both("customers"))


@query("bronze_null_profile")
def bronze_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.null_profile(SampleBronze(spark, sf_dir).both("customers"))


@query("bronze_sample_customers")
def bronze_sample_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.sample(SampleBronze(spark, sf_dir).both("customers"), "customer_id")


@query("bronze_sample_transactions")
def bronze_sample_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.sample(SampleBronze(spark, sf_dir).both("transactions"), "transaction_id")


@query("silver_row_counts")
def silver_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = silver(spark, sf_dir)
    return verify.row_counts({f"SILVER_{e.upper()}": df for e, df in tables.items()})


@query("silver_valid_counts")
def silver_valid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = silver(spark, sf_dir)
    return verify.valid_counts({f"SILVER_{e.upper()}": df for e, df in tables.items()})


@query("gold_row_counts")
def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = star(spark, sf_dir)
    return verify.row_counts({name.upper(): df for name, df in tables.items()})


@query("run_log")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of the four Silver loads, appended to a table and read back."""
    path = new_folder(spark, "run-log")
    audit.append(audit.silver_load_rows(silver(spark, sf_dir), AS_OF), path)
    return spark.read.schema(audit.RUN_LOG_SCHEMA).parquet(path)


@query("run_log_observed")
def run_log_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of Silver loads, counted by the jobs that write them, and of the quality gate, which stops the run."""
    root, loads, sample = new_folder(spark, "observed-run"), audit.Loads(), SampleBronze(spark, sf_dir)
    log = posixpath.join(root, "run_log")
    stored = daily_batch.store_silver({e: sample.both(e) for e in ENTITIES}, AS_OF, posixpath.join(root, "silver"), loads)
    audit.append(loads.log_rows(spark, ENTITIES, "SILVER", "bronze_to_silver", AS_OF), log)
    gate = audit.failure_logged(
        spark, log, run_id=f"QUALITY_{compact_stamp(AS_OF)}", pipeline="data_quality", entity="silver", as_of=AS_OF)
    with contextlib.suppress(quality.CriticalChecksFailed), gate:
        tables = {f"silver_{e}": df for e, df in stored.items()}
        quality.require_no_critical_failure(quality.run_suite(tables, SILVER_CHECKS, AS_OF))
    return spark.read.schema(audit.RUN_LOG_SCHEMA).parquet(log)


# ---- customer history -----------------------------------------------------
def _first_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after the first delivery, which the history starts from."""
    first = to_silver(SampleBronze(spark, sf_dir).first("customers"), "customers", AS_OF)
    return scd2.bootstrap(gold.dim_customers(stage(first, "silver-customers"), AS_OF), AS_OF)


def _second_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after the second delivery, over all of Bronze."""
    return silver(spark, sf_dir, "customers")["customers"]


def _history(
    spark: SparkSession, sf_dir: str, as_of: dt.datetime = AS_OF
) -> tuple[DataFrame, scd2.HistoryRun]:
    first = stage(_first_dimension(spark, sf_dir), "dim-customers")
    return first, scd2.apply_history(first, _second_silver(spark, sf_dir), as_of)


#: A day of the second delivery that lies inside the dates of the facts, and days on both sides of it.
MIDDLE = dt.datetime(2025, 6, 30)
DAYS_AROUND = [dt.date(2024, 2, 15), dt.date(2025, 6, 29), dt.date(2025, 6, 30), dt.date(2026, 1, 1)]


@query("scd2_bootstrap")
def scd2_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_dimension(spark, sf_dir)


@query("scd2_record_hash")
def scd2_record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir, "customers")["customers"]
    return rows.select("customer_id", scd2.record_hash().alias("record_hash"))


@query("scd2_classify")
def scd2_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.classify(_first_dimension(spark, sf_dir), _second_silver(spark, sf_dir))


@query("scd2_expire")
def scd2_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, run = _history(spark, sf_dir)
    return scd2.expire(first, run.changes, AS_OF)


@query("scd2_insert_versions")
def scd2_insert_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, run = _history(spark, sf_dir)
    return scd2.new_versions(first, run.changes, AS_OF)


@query("scd2_dim_customers")
def scd2_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[1].dimension


def _history_by_files(spark: SparkSession, sf_dir: str) -> history_store.HistoryDay:
    """The second delivery applied to the stored dimension, file by file."""
    root = new_folder(spark, "history")
    first = stage(_first_dimension(spark, sf_dir), "dim-customers")
    history_store.start(spark, root, first, rows_per_file=SAMPLE_ROWS_PER_FILE)
    delivered = to_silver(SampleBronze(spark, sf_dir).following("customers"), "customers", AS_OF)
    return history_store.apply_day(spark, root, delivered, AS_OF, rows_per_file=SAMPLE_ROWS_PER_FILE)


@query("scd2_copy_on_write")
def scd2_copy_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.read(spark, _history_by_files(spark, sf_dir).version, history_store.TABLE)


@query("scd2_run_summary")
def scd2_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[1].summary


@query("scd2_run_log")
def scd2_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)[1].log_row


@query("scd2_verify_counts")
def scd2_verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.version_counts(scd2_dim_customers(spark, sf_dir))


@query("scd2_history_sample")
def scd2_history_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.history_sample(scd2_dim_customers(spark, sf_dir))


@query("scd2_as_of")
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state on days before and after the second versions begin."""
    dim = stage(_history(spark, sf_dir, MIDDLE)[1].dimension, "dim-customers")
    days = [scd2.state_on(dim, day).select(F.lit(day).alias("as_of_day"), "*") for day in DAYS_AROUND]
    return reduce(DataFrame.unionByName, days)


@query("scd2_as_of_transactions")
def scd2_as_of_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid transactions by the status their customer had on the day."""
    dim = stage(_history(spark, sf_dir, MIDDLE)[1].dimension, "dim-customers")
    facts = gold.valid_rows(silver(spark, sf_dir, "transactions")["transactions"]).select(
        "transaction_id", "customer_id", "amount", "transaction_date"
    )
    dated = scd2.with_state_at(
        facts, dim.withColumnRenamed("status", "customer_status"), "transaction_date",
        ["customer_status"],
    )
    return dated.groupBy("customer_status").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("total_amount")
    )


# ---- reports --------------------------------------------------------------
@query("report_aml_activity")
def report_aml_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = star(spark, sf_dir)
    return reports.aml_activity(
        tables["fact_transactions"], tables["fact_fraud"], tables["dim_date"]
    )


@query("report_severity_ranking")
def report_severity_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.severity_ranking(fact_fraud(spark, sf_dir))


@query("report_review_sla")
def report_review_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.review_sla(fact_fraud(spark, sf_dir), gold.dim_date(spark, AS_OF))


# ---- data quality ---------------------------------------------------------
def _raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sample = SampleBronze(spark, sf_dir)
    return {f"raw_{e}": sample.both(e) for e in ENTITIES}


def _silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {f"silver_{e}": df for e, df in stored_silver(spark, sf_dir).items()}


@query("dq_silver_suite")
def dq_silver_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(_silver_tables(spark, sf_dir), SILVER_CHECKS, AS_OF)


@query("dq_silver_suite_carried")
def dq_silver_suite_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver suite over both deliveries from the first one's state and the second one's changes."""
    sample, root = SampleBronze(spark, sf_dir), new_folder(spark, "dq-state")
    latest = stage_all({e: latest_per_key(sample.first(e), e) for e in ENTITIES}, "latest-rows")
    counted = {f"silver_{e}": clean_silver(df, e, AS_OF) for e, df in latest.items()}
    quality_state.start(spark, root, counted, SILVER_CHECKS, rows_per_file=SAMPLE_ROWS_PER_FILE)
    batches = stage_all({e: sample.following(e) for e in ENTITIES}, "batches")
    changes = {f"silver_{e}": quality_state.day_changes(latest[e], batches[e], e, AS_OF) for e in ENTITIES}
    gone, came = ({name: pair[n] for name, pair in changes.items()} for n in (0, 1))
    version = quality_state.advance(spark, root, gone, came, SILVER_CHECKS, rows_per_file=SAMPLE_ROWS_PER_FILE)
    return quality_state.suite(spark, version, SILVER_CHECKS, AS_OF)


@query("dq_gold_suite")
def dq_gold_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(star(spark, sf_dir)[1], GOLD_CHECKS, AS_OF)


@query("dq_bronze_rules")
def dq_bronze_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(_raw_tables(spark, sf_dir), BRONZE_RULES, AS_OF)


@query("dq_silver_rules")
def dq_silver_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(_silver_tables(spark, sf_dir), SILVER_RULES, AS_OF)


@query("dq_gold_rules")
def dq_gold_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = star(spark, sf_dir)
    first = scd2.bootstrap(tables["dim_customers"], AS_OF)
    run = scd2.apply_history(first, _second_silver(spark, sf_dir), AS_OF)
    tables["dim_customers_history"] = run.dimension
    return quality.run_suite(tables, GOLD_RULES, AS_OF)


def _both_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, tables = star(spark, sf_dir)
    silver_tables = {f"silver_{e}": df for e, df in stored.items()}
    return quality.with_suite_name(
        quality.run_suite(silver_tables, SILVER_CHECKS, AS_OF), "silver_layer"
    ).unionByName(
        quality.with_suite_name(quality.run_suite(tables, GOLD_CHECKS, AS_OF), "gold_layer")
    )


@query("dq_suite_summary")
def dq_suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarize(_both_suites(spark, sf_dir))


@query("dq_critical_gate")
def dq_critical_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The critical failures that would stop the run, with their escalation."""
    return quality.critical_failures(_both_suites(spark, sf_dir))


@query("dq_report_json")
def dq_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver report written as JSON and read back as one row per check."""
    results = dq_silver_suite(spark, sf_dir)
    path = quality.save_report(results, "silver_layer", AS_OF, new_folder(spark, "dq-report"))
    report = spark.read.json(path)
    return report.select(
        "suite_name", "summary.total", "summary.passed", "summary.pass_rate",
        F.inline("checks"),
    ).select(
        "suite_name", "total", "passed", "pass_rate", "check_name", "table", "severity",
        "expected", "actual", "status",
    )


@query("coded_rejects")
def coded_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a rule, later copies of a key, and balances that do not add up."""
    raw = stage_all(_raw_tables(spark, sf_dir), "bronze")
    stored = stage_all({f"silver_{e}": to_silver(raw[f"raw_{e}"], e, AS_OF) for e in ENTITIES}, "silver")
    by_rule = quality.coded_rejects({**raw, **stored}, BRONZE_RULES + SILVER_RULES, AS_OF)
    copies = rejects.all_duplicates({e: raw[f"raw_{e}"] for e in ENTITIES}, AS_OF)
    return by_rule.unionByName(quality.coded_duplicates(copies, SILVER_RULES)).unionByName(
        quality.coded_breaks(_breaks(stored["silver_transactions"]), "silver_transactions", AS_OF)
    )


@query("ri_orphans")
def ri_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans(stored_silver(spark, sf_dir))


# ---- contracts ------------------------------------------------------------
def _contract_query(entity: str) -> None:
    @query(f"contract_{entity}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return contracts.verdicts(SampleBronze(spark, sf_dir).both(entity), entity, AS_OF)


for _entity in ENTITIES:
    _contract_query(_entity)


@query("mask_account_numbers")
def mask_account_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked numbers stay; plain ones (here the digits of the id) get masked."""
    raw = SampleBronze(spark, sf_dir).both("accounts")
    number = F.when(F.upper("account_type") == "CHECKING", F.substring("account_id", 4, 10))
    mixed = raw.withColumn("account_number", F.coalesce(number, "account_number"))
    return contracts.masked_accounts(mixed)


# ---- landing and Bronze ---------------------------------------------------
LANDING_DAY = dt.date(2024, 1, 1)
NEXT_LANDING_DAY = dt.date(2024, 1, 2)


def _bronze_load_query(entity: str) -> None:
    @query(f"bronze_load_{entity}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """An extract landed as CSV, parsed into Bronze and read back."""
        root, table = new_folder(spark, "landing"), new_folder(spark, "bronze")
        landing.land_csv(SampleBronze(spark, sf_dir).first(entity), root, entity, LANDING_DAY)
        parsed = bronze.read_extract(
            spark, landing.entity_folder(root, entity), entity, day=LANDING_DAY
        )
        bronze.store(bronze.to_bronze(parsed, entity, AS_OF), table)
        return bronze.rows(spark, table, entity).drop("_source_file")


for _entity in ENTITIES:
    _bronze_load_query(_entity)


@query("bronze_quarantine")
def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag lines, of which those without a review lack their last fields."""
    names = SOURCE_COLUMNS["fraud_flags"]
    fields = [F.coalesce(c, F.lit("")) for c in names]
    line = F.when(
        F.col("reviewed_at").isNull(), F.concat_ws(",", *fields[:9])
    ).otherwise(F.concat_ws(",", *fields))
    root, table = new_folder(spark, "landing"), new_folder(spark, "bronze")
    flags = SampleBronze(spark, sf_dir).first("fraud_flags")
    flags.select(line.alias(",".join(names))).write.options(
        header="true", sep="\u0001", quote="\u0000",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(root)
    parsed = bronze.read_extract(spark, root, "fraud_flags")
    bronze.store(bronze.to_bronze(parsed, "fraud_flags", AS_OF), table)
    return bronze.quarantine(spark, table, "fraud_flags").select("record", "_source_entity", "_batch_id")


@query("bronze_quoted_breaks")
def bronze_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements whose description has line breaks, quotes and separators, landed and loaded from many splits."""
    root, table = new_folder(spark, "landing"), new_folder(spark, "bronze")
    rows = SampleBronze(spark, sf_dir).first("transactions")
    note = F.concat(F.col("transaction_id"), F.lit(' said "so",\nand\n\nmore'))
    noted = rows.withColumn("description", F.when(F.col("channel") != "atm", note).otherwise(F.col("transaction_id")))
    landing.land_csv(noted, root, "transactions", LANDING_DAY)
    found = csv_records.records(spark, landing.day_folder(root, "transactions", LANDING_DAY))
    loaded = bronze.to_bronze(csv_records.parsed(found, "transactions"), "transactions", AS_OF, "path")
    bronze.store(loaded, table)
    return bronze.rows(spark, table, "transactions").select("transaction_id", "description", "reference_number", "_batch_id")


@query("bronze_load_results")
def bronze_load_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of loading each month's flags: those without a review lack fields, confirmed ones have a line break."""
    names = SOURCE_COLUMNS["fraud_flags"]
    flags = SampleBronze(spark, sf_dir).first("fraud_flags").withColumn(
        "flag_reason", F.when(F.col("is_confirmed_fraud") == "True", F.lit('"two\nlines"')).otherwise(F.lit("one")))
    fields = [F.coalesce(c, F.lit("")) for c in names]
    line = F.when(F.col("reviewed_at").isNull(), F.concat_ws(",", *fields[:9])).otherwise(F.concat_ws(",", *fields))
    month = F.coalesce(F.substring("flagged_at", 1, 7), F.lit("none")).alias("month")
    # Rows of one id lie with the short ones first, then those of two lines, so that line numbers have one answer.
    place = F.concat_ws(
        "|", F.coalesce("flag_id", F.lit("")), F.when(F.col("reviewed_at").isNull(), "0").otherwise("1"),
        F.when(F.col("is_confirmed_fraud") == "True", "0").otherwise("1"))
    lines = stage(flags.select(month, place.alias("place"), line.alias("value")), "flag-lines")
    header = lines.select("month").distinct().select("month", F.lit(None).cast("string").alias("place"), F.lit(",".join(names)).alias("value"))
    root = new_folder(spark, "landing")
    ordered = lines.unionAll(header).repartition("month").sortWithinPartitions("month", F.col("place").asc_nulls_first())
    ordered.select("month", "value").write.partitionBy("month").text(root)
    rows = csv_records.parsed(csv_records.records(spark, root, glob="*"), "fraud_flags")
    results = csv_records.load_results(landing.listing(spark, root), rows, "fraud_flags")
    return results.withColumn("month", F.url_decode(F.regexp_extract("path", "month=([^/]+)/", 1))).drop("path")


def backdate(spark: SparkSession, folder: str, days: int) -> None:
    """Give the files of a folder older times, as copies have that keep theirs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        if status.isFile():
            fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query("bronze_incremental")
def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, three runs: every file is loaded by exactly one of them.

    The files of the second delivery are a month older than those of the first.
    """
    sample = SampleBronze(spark, sf_dir)
    root, table = new_folder(spark, "landing"), new_folder(spark, "bronze")
    checkpoint = new_folder(spark, "ingest-progress")
    source = landing.entity_folder(root, "transactions")
    runs = [(sample.first, LANDING_DAY), (sample.following, NEXT_LANDING_DAY), (None, None)]
    for number, (delivery, day) in enumerate(runs):
        if delivery is not None:
            landing.land_csv(delivery("transactions"), root, "transactions", day)
        if day == NEXT_LANDING_DAY:
            backdate(spark, landing.day_folder(root, "transactions", day), 30)
        ingest_new_files(
            spark, source, "transactions", table, checkpoint, AS_OF + dt.timedelta(days=number)
        )
    return verify.batches(bronze.rows(spark, table, "transactions"))


@query("bronze_forced_reload")
def bronze_forced_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract loaded once as new files and twice by force: all three loads are kept."""
    root, table = new_folder(spark, "landing"), new_folder(spark, "bronze")
    source = landing.entity_folder(root, "accounts")
    landing.land_csv(SampleBronze(spark, sf_dir).first("accounts"), root, "accounts", LANDING_DAY)
    ingest_new_files(spark, source, "accounts", table, new_folder(spark, "ingest-progress"), AS_OF)
    for number in (1, 2):
        parsed = bronze.read_extract(spark, source, "accounts")
        bronze.store(
            bronze.to_bronze(parsed, "accounts", AS_OF + dt.timedelta(days=number)), table
        )
    return verify.batches(bronze.rows(spark, table, "accounts"))


#: About the largest file that a delivery is landed in, well under what may be loaded.
LANDING_FILE_MB = 128


def _landed(spark: SparkSession, sf_dir: str, *entities: str) -> str:
    """Each entity's first delivery, in two files or, where it is large, more."""
    sample, root = SampleBronze(spark, sf_dir), new_folder(spark, "landing")
    for entity in entities:
        rows = stage(sample.first(entity), "delivery")
        landing.land_csv(landing.in_files(rows, file_mb=LANDING_FILE_MB), root, entity, LANDING_DAY)
    return root


def _with_notes(spark: SparkSession, root: str, entity: str) -> str:
    """Put a file of another type beside an entity's extracts."""
    folder = landing.day_folder(root, entity, LANDING_DAY)
    spark.range(1).selectExpr("'see the other files' as value").write.mode("append").text(folder)
    return root


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


@query("landing_manifest")
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each entity and status, the rows they hold, and hashes that a second read does not confirm."""
    root = _with_notes(spark, _landed(spark, sf_dir, *ENTITIES), "customers")
    listed = stage(landing.manifest(spark, root, AS_OF), "manifest")
    again = landing.manifest(spark, root, AS_OF).select("path", F.col("checksum_md5").alias("second_md5"))
    lines = spark.read.option("recursiveFileLookup", "true").text(root).groupBy(
        F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("lines"))
    whole = listed.join(again, "path").join(lines, "path", "left")
    return whole.groupBy("entity", "status").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.when(F.col("status") == "SUCCESS", F.col("lines") - 1)).alias("data_rows"),
        F.count_if(~F.col("checksum_md5").eqNullSafe(F.col("second_md5"))).alias("unconfirmed"),
    )


@query("landing_manifest_totals")
def landing_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _with_notes(spark, _landed(spark, sf_dir, *ENTITIES), "accounts")
    listed = stage(landing.manifest(spark, root, AS_OF), "manifest")
    sizes = landing.listing(spark, root).groupBy("entity").agg(F.sum("length").alias("listed_bytes"))
    return landing.manifest_totals(listed).join(sizes, "entity").select(
        "entity", "total_files", "successful", "failed",
        (F.col("total_bytes") == F.col("listed_bytes")).alias("bytes_agree"),
    )


@query("landing_eligibility")
def landing_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each entity by verdict, under a limit between those of accounts and the larger ones of customers."""
    root = _with_notes(spark, _landed(spark, sf_dir, "customers"), "customers")
    accounts = stage(SampleBronze(spark, sf_dir).first("accounts"), "delivery")
    landing.land_csv(landing.in_files(accounts, file_mb=LANDING_FILE_MB / 4, at_least=4), root, "accounts", LANDING_DAY)
    listed = landing.listing(spark, root)
    largest = listed.where("entity = 'accounts'").agg(F.max("length")).first()[0]
    files = landing.eligibility(listed, max_mb=largest / landing.BYTES_PER_MB)
    return files.groupBy("entity", "is_valid", "reason").agg(F.count(F.lit(1)).alias("files"))


@query("landing_reconciliation")
def landing_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest against the files after a further delivery, one file changed and one gone."""
    root = _landed(spark, sf_dir, *ENTITIES)
    promised = stage(landing.manifest(spark, root, AS_OF), "manifest")
    following = stage(SampleBronze(spark, sf_dir).following("customers"), "delivery")
    landing.land_csv(landing.in_files(following, file_mb=LANDING_FILE_MB), root, "customers", NEXT_LANDING_DAY)
    first = {
        r.entity: r.path for r in promised.groupBy("entity").agg(F.min("path").alias("path")).collect()
    }
    fs, gone = _file_system(spark, first["fraud_flags"])
    fs.delete(gone, False)
    fs, changed = _file_system(spark, first["accounts"])
    stream = fs.create(changed, True)
    stream.writeBytes("other content")
    stream.close()
    states = landing.reconcile(promised, landing.manifest(spark, root, AS_OF))
    return states.groupBy("entity", "state").agg(F.count(F.lit(1)).alias("files"))


@query("landing_missing_entities")
def landing_missing_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landed(spark, sf_dir, "customers", "transactions")
    return landing.missing_entities(landing.listing(spark, root))


@query("bronze_checksums")
def bronze_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows that carry the checksum of the file they came from."""
    root = _landed(spark, sf_dir, "accounts")
    parsed = bronze.read_extract(spark, landing.entity_folder(root, "accounts"), "accounts")
    sums = stage(landing.manifest(spark, root, AS_OF), "manifest")
    loaded = bronze.with_checksums(bronze.to_bronze(parsed, "accounts", AS_OF), sums)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    second = files.where(F.col("length") <= LANDING_MAX_MB * 1024 * 1024).select(
        F.col("path").alias("_source_file"), F.md5("content").alias("_second"))
    return loaded.join(second, "_source_file", "left").select(
        "account_id", (F.col("_checksum") == F.col("_second")).alias("checksum_confirmed"),
        F.col("_source_file").endswith(".csv").alias("file_named"),
    )


@query("json_sink_accounts")
def json_sink_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "landing")
    landing.land_json(SampleBronze(spark, sf_dir).first("accounts"), root, "accounts", LANDING_DAY)
    schema = ", ".join(f"{c} string" for c in SOURCE_COLUMNS["accounts"])
    return spark.read.schema(schema).json(landing.day_folder(root, "accounts", LANDING_DAY))


@query("required_tables")
def required_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables published by name, and which of the wanted names exist."""
    root = new_folder(spark, "published")
    daily_batch.store_silver(
        {e: SampleBronze(spark, sf_dir).first(e) for e in ENTITIES}, AS_OF, root
    )
    database = f"brookledger_{root[-12:]}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{root}/_names'")
    for entity in ENTITIES:
        publish(spark, database, f"silver_{entity}", f"{root}/{entity}")
    wanted = [*[f"silver_{e}" for e in ENTITIES], "dim_date"]
    present = stage(tables_present(spark, database, wanted), "present")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return present


# ---- ledger ---------------------------------------------------------------
def _breaks(transactions: DataFrame) -> DataFrame:
    """Valid movements whose balance does not follow from the one before, by month."""
    return ledger.balance_breaks(
        gold.valid_rows(transactions).withColumn("page", F.date_format("transaction_date", "yyyyMM")),
        account="account_id", order=["transaction_date", "transaction_id"],
        amount="amount", balance="balance_after", chunk="page",
    )


@query("balance_breaks")
def balance_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_silver(spark, sf_dir, "transactions")
    return _breaks(stored["transactions"]).select(
        "account_id", "transaction_id", "amount", "balance_after",
        F.col("expected_balance").cast("decimal(18,2)").alias("expected_balance"),
        "reason_code",
    )
