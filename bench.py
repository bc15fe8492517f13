"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the sample tables, BENCH_CPUS the local cores. Each query
runs once in full, writing its rows to nowhere, after a small warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from brookledger.catalog import QUERIES
from brookledger.session import build_session

HEADLINE = [
    "silver_customers", "silver_accounts", "silver_transactions", "silver_fraud_flags",
    "reject_records", "reject_summary", "duplicate_rejects", "coded_rejects",
    "dim_customers", "dim_accounts", "dim_date_activity", "fact_transactions", "fact_fraud",
    "scd2_classify", "scd2_dim_customers", "scd2_as_of_transactions",
    "dq_bronze_rules", "dq_silver_suite", "dq_gold_suite", "ri_orphans",
    "contract_customers", "contract_transactions", "bronze_load_transactions",
    "report_aml_activity", "balance_breaks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "brookledger-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="brookledger-bench-"),
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["silver_accounts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in wanted:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
