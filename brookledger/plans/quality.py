"""Data-quality suites: many rules, few passes.

All row rules of a table are counted in one aggregate over it, and each
uniqueness rule adds one grouped count of its key column. Both combine before
their shuffle, so what travels is a few numbers per task, or one row per key.
Each aggregate then unfolds into a result row per rule.
"""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Mapping, Sequence
from dataclasses import asdict
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookledger.fixed_values import BUSINESS_KEY, ENTITIES, ESCALATION
from brookledger.functions.calendar import compact_stamp, moment
from brookledger.operators.dedup import all_but_first
from brookledger.operators.sieve import may_match
from brookledger.plans.rule_catalogue import (
    REJECT,
    REJECT_REPEATS,
    Check,
    Measure,
    Rule,
)
from brookledger.sources.tables import session_of, side_by_side, stage

PASSED, FAILED, WARNING = "PASSED", "FAILED", "WARNING"
Item = Check | Rule


class CriticalChecksFailed(ValueError):
    """Raised when a check of severity CRITICAL did not pass."""

    def __init__(self, names: list[str]) -> None:
        super().__init__(f"Critical DQ checks failed: {names}")
        self.names = names


def meets(actual: str, expected: str) -> str:
    """SQL for whether a number meets '>= n', '> n', '= n', '<= n' or '< n'.

    Any other text is met by nothing, and nothing is met by NULL.
    """
    sign, _, bound = expected.strip().partition(" ")
    try:
        limit = float(bound)
    except ValueError:
        return "false"
    if sign not in (">=", ">", "=", "<=", "<"):
        return "false"
    return f"coalesce({actual} {sign} {limit!r}D, false)"


def _count_of(measure: Measure) -> str:
    if measure.kind == "rows":
        return "cast(count(1) AS double)"
    hits = f"cast(count_if({measure.predicate}) AS double)"
    if measure.kind == "breaches":
        return hits
    return f"round({hits} * 100.0D / nullif(count(1), 0), 2)"


def _text(value: object) -> str:
    """A SQL string literal, or a NULL of type string."""
    if value is None:
        return "cast(NULL AS string)"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _unfold(
    counted: DataFrame, items: Sequence[Item], actuals: Sequence[str], as_of: dt.datetime
) -> DataFrame:
    """One result row per rule from a one-row aggregate.

    One SQL expression for all of them: suites are many small constants, which
    would be slow to put together call by call.
    """
    rows = []
    for item, actual in zip(items, actuals):
        facts = asdict(item)
        facts.pop("measure")
        labels = [f"'{name}', {_text(value)}" for name, value in facts.items()]
        met = meets(actual, item.expected)
        results = [
            f"'actual', {actual}",
            f"'status', if({met}, '{PASSED}', '{FAILED}')",
            "'error_message', ''",
            f"'executed_at', timestamp_ntz'{as_of.isoformat(sep=' ')}'",
        ]
        rows.append(f"named_struct({', '.join(labels + results)})")
    return counted.select(F.expr(f"inline(array({', '.join(rows)}))"))


def _measured(table: DataFrame, items: Sequence[Item], as_of: dt.datetime) -> list[DataFrame]:
    grouped_kinds = ("repeats", "not_one")
    frames = []
    scanned = [i for i in items if i.measure.kind not in grouped_kinds]
    if scanned:
        names = [f"m{n}" for n in range(len(scanned))]
        counts = [
            F.expr(_count_of(i.measure)).alias(n) for i, n in zip(scanned, names)
        ]
        frames.append(_unfold(table.agg(*counts), scanned, names, as_of))
    for item in items:
        if item.measure.kind not in grouped_kinds:
            continue
        if item.measure.kind == "repeats":
            per_value, wrong = F.count(F.lit(1)), F.col("n") > 1
        else:
            per_value, wrong = F.count_if(F.expr(item.measure.predicate)), F.col("n") != 1
        counted = (
            table.groupBy(item.measure.column)
            .agg(per_value.alias("n"))
            .agg(F.count_if(wrong).cast("double").alias("m"))
        )
        frames.append(_unfold(counted, [item], ["m"], as_of))
    return frames


def _not_measured(
    spark: SparkSession, items: Sequence[Item], error: str, as_of: dt.datetime
) -> DataFrame:
    """A rule that cannot be evaluated has failed; the reason is kept."""
    nothing = ["cast(NULL AS double)"] * len(items)
    rows = _unfold(spark.range(1), items, nothing, as_of)
    return rows.withColumns({"status": F.lit(FAILED), "error_message": F.lit(error)})


def run_suite(
    tables: Mapping[str, DataFrame],
    items: Sequence[Item],
    as_of: dt.datetime,
    *,
    spark: SparkSession | None = None,
) -> DataFrame:
    """One row per check or rule with its actual value and status."""
    spark = spark or session_of(tables)
    frames: list[DataFrame] = []
    for table in dict.fromkeys(i.table for i in items):
        own = [i for i in items if i.table == table]
        if table not in tables:
            frames.append(_not_measured(spark, own, f"table {table} not found", as_of))
            continue
        try:
            frames += _measured(tables[table], own, as_of)
        except PySparkException as error:
            frames.append(_not_measured(spark, own, str(error), as_of))
    return reduce(DataFrame.unionByName, frames)


def run_suite_apart(
    tables: Mapping[str, DataFrame],
    items: Sequence[Item],
    as_of: dt.datetime,
    *,
    spark: SparkSession | None = None,
) -> DataFrame:
    """``run_suite`` with results stored at once, so that a check that fails
    while it runs fails alone: its message is kept, the others have results.

    A table's checks share their passes; only if those break is each of its
    checks run by itself.
    """
    spark = spark or session_of(tables)

    def stored(own: Sequence[Item]) -> list[DataFrame]:
        try:
            return [stage(run_suite(tables, own, as_of, spark=spark), "dq-results")]
        except PySparkException as error:
            if len(own) == 1:
                return [_not_measured(spark, own, str(error), as_of)]
            return [df for item in own for df in stored([item])]

    names = dict.fromkeys(i.table for i in items)
    frames = [df for t in names for df in stored([i for i in items if i.table == t])]
    return reduce(DataFrame.unionByName, frames)


def with_suite_name(results: DataFrame, suite: str) -> DataFrame:
    return results.select(F.lit(suite).alias("suite_name"), "*")


def summarize(results: DataFrame) -> DataFrame:
    """Totals per suite; results carry a ``suite_name`` column."""
    total = F.count(F.lit(1))
    passed = F.count_if(F.col("status") == PASSED)
    failed = F.col("status") == FAILED
    return results.groupBy("suite_name").agg(
        total.alias("total"),
        passed.alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(F.col("status") == WARNING).alias("warnings"),
        F.round(passed.cast("double") * 100.0 / total, 1).alias("pass_rate"),
        F.count_if(failed & (F.col("severity") == "CRITICAL")).alias("critical_failures"),
    )


def with_escalation(results: DataFrame) -> DataFrame:
    """Failed rows with who answers for them and how fast."""
    first, *rest = ESCALATION.items()

    def pick(at: int) -> Column:
        chain = F.when(F.col("severity") == first[0], first[1][at])
        for severity, values in rest:
            chain = chain.when(F.col("severity") == severity, values[at])
        return chain

    return results.filter(F.col("status") == FAILED).withColumns(
        {"response_time": pick(0), "escalation": pick(1)}
    )


def critical_failures(results: DataFrame) -> DataFrame:
    return with_escalation(results).filter(F.col("severity") == "CRITICAL")


def require_no_critical_failure(results: DataFrame) -> None:
    """Stop the run if a critical check failed; there are few checks to fetch."""
    names = [r["check_name"] for r in critical_failures(results).select("check_name").collect()]
    if names:
        raise CriticalChecksFailed(sorted(names))


def save_report(results: DataFrame, suite: str, as_of: dt.datetime, folder: str) -> str:
    """One JSON document per suite run: its summary and all its checks."""
    path = posixpath.join(folder, f"dq_report_{suite}_{compact_stamp(as_of)}")
    named = with_suite_name(results, suite)
    checks = named.groupBy("suite_name").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "check_name", "description", "layer", "table", "severity", "expected",
                    F.col("actual").cast("string").alias("actual"), "status",
                    "error_message", "executed_at",
                )
            )
        ).alias("checks")
    )
    summary = summarize(named).select(
        "suite_name",
        moment(as_of).alias("generated_at"),
        F.struct(
            "total", "passed", "failed", "warnings",
            F.format_string("%.1f%%", "pass_rate").alias("pass_rate"),
            "critical_failures",
        ).alias("summary"),
    )
    summary.join(checks, "suite_name").coalesce(1).write.json(path)
    return path


# ---- rejects by rule ------------------------------------------------------
def coded_rejects(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], as_of: dt.datetime
) -> DataFrame:
    """Every (row, broken rule) of the rules that reject records.

    One pass per table evaluates all its rules; only broken ones are unfolded.
    Copies of a key beyond the first are rejected as duplicates.
    """
    def of_table(name: str) -> list[DataFrame]:
        key = BUSINESS_KEY[next(e for e in ENTITIES if name.endswith(e))]
        own = [r for r in rules if r.table == name]
        return [
            *_broken_rows(tables[name], key, [r for r in own if r.action == REJECT]),
            *_further_copies(tables[name], key, [r for r in own if r.action == REJECT_REPEATS]),
        ]

    found = side_by_side(session_of(tables), of_table, tables)
    frames = [df for of_one in found for df in of_one]
    return reduce(DataFrame.unionByName, frames).withColumn("rejected_at", moment(as_of))


def _broken_rows(table: DataFrame, key: str, rules: Sequence[Rule]) -> list[DataFrame]:
    if not rules:
        return []
    verdicts = [F.when(F.expr(r.measure.predicate), _verdict(r)) for r in rules]
    return [
        table.select(
            F.col(key).alias("business_id"),
            F.col("_batch_id").alias("batch_id"),
            F.inline(F.array_compact(F.array(*verdicts))),
        )
    ]


def _further_copies(table: DataFrame, key: str, rules: Sequence[Rule]) -> list[DataFrame]:
    known = table.filter(F.col(key).isNotNull())
    return [
        all_but_first(known, key, _any_order(table, key)).select(
            F.col(key).alias("business_id"),
            F.col("_batch_id").alias("batch_id"),
            F.inline(F.array(_verdict(rule))),
        )
        for rule in rules
    ]


def coded_duplicates(copies: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Later copies of a key in Bronze, under the rule that wants the key unique.

    ``copies`` are the rows of ``rejects.all_duplicates``; a missing key is no copy.
    """
    frames = []
    for rule in (r for r in rules if r.action == REJECT_REPEATS):
        entity = next(e for e in ENTITIES if rule.table.endswith(e))
        own = copies.filter((F.col("entity") == entity) & F.col("business_id").isNotNull())
        verdict = _verdict(rule).withField("source_table", F.lower("source_table"))
        frames.append(own.select("business_id", "batch_id", F.inline(F.array(verdict)), "rejected_at"))
    return reduce(DataFrame.unionByName, frames)


def coded_breaks(breaks: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """Entries of a ledger whose balance does not add up."""
    return breaks.select(
        F.col("transaction_id").alias("business_id"), F.col("_batch_id").alias("batch_id"),
        F.lit(None).cast("string").alias("rule_id"), F.lit(table).alias("source_table"),
        "reason_code", F.lit("HIGH").alias("severity"), moment(as_of).alias("rejected_at"),
    )


def _any_order(table: DataFrame, key: str) -> str:
    return ", ".join(c for c in table.columns if c != key)


def _verdict(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.table).alias("source_table"),
        F.lit(rule.reason_code).alias("reason_code"),
        F.lit(rule.severity).alias("severity"),
    )


# ---- references to missing parents ----------------------------------------
REFERENCES = [
    ("accounts", "customer_id", "customers"),
    ("transactions", "account_id", "accounts"),
    ("transactions", "customer_id", "customers"),
    ("fraud_flags", "transaction_id", "transactions"),
    ("fraud_flags", "account_id", "accounts"),
    ("fraud_flags", "customer_id", "customers"),
]


#: A parent is sieved before its exchange if it has this many times the rows that refer to it.
SIEVE_RATIO = 4


def orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign-key values without a parent, and how many rows hold each.

    Each child is read once for all its references, and rows are counted per
    value before the one anti-join, so a value held by a third of the rows is
    one row in it. Keys of a parent much larger than what refers to it are held
    against a Bloom filter of the references first. A missing value is no
    orphan. ``tables`` are counted: pass stored tables.
    """
    values = reduce(DataFrame.unionByName, [
        _references(tables[child], child) for child in dict.fromkeys(c for c, _, _ in REFERENCES)
    ])
    counted = values.groupBy(*values.columns).agg(F.count(F.lit(1)).alias("row_count"))
    parents = reduce(DataFrame.unionByName, [
        _referred(tables, parent).select(F.lit(parent).alias("parent_table"), F.col(BUSINESS_KEY[parent]).alias("missing_id"))
        for parent in dict.fromkeys(p for _, _, p in REFERENCES)
    ])
    return counted.join(parents, ["parent_table", "missing_id"], "left_anti").select(
        "child_table", "foreign_key", "parent_table", "missing_id", "row_count",
        F.lit("REFERENTIAL_INTEGRITY").alias("reason_code"),
    )


def _references(rows: DataFrame, child: str) -> DataFrame:
    """A row for each foreign-key value of each row of a child."""
    fields = [
        F.struct(F.lit(column).alias("foreign_key"), F.lit(parent).alias("parent_table"), F.col(column).alias("missing_id"))
        for c, column, parent in REFERENCES if c == child
    ]
    return rows.select(F.inline(F.array(*fields))).where("missing_id IS NOT NULL").select(
        F.lit(child).alias("child_table"), "foreign_key", "parent_table", "missing_id")


def _referred(tables: Mapping[str, DataFrame], parent: str) -> DataFrame:
    """The key column of a parent, without most rows that nothing refers to if there are many of them."""
    key = BUSINESS_KEY[parent]
    keys = tables[parent].select(key)
    asking = reduce(DataFrame.unionAll, [tables[c].select(F.col(column).alias("_asked")) for c, column, p in REFERENCES if p == parent])
    if keys.count() < SIEVE_RATIO * asking.count():
        return keys
    return may_match(keys, key, asking, "_asked")
