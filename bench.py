"""Time the headline queries and print one JSON line.

BENCH_STORED=1 writes the derived billing tables first and times the queries over these, which
leaves the cost of deriving them out of the figures.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from duesmith.plans import catalog
from duesmith.session import session
from duesmith.sources.billing_views import VIEWS
from duesmith.sources.tables import Tables
from duesmith.sources.workspace import clear_work, new_folder

HEADLINE = (
    "account_aging_target_date",
    "account_aging_due_date",
    "account_total_balance",
    "ar_aging_snapshot",
    "ar_aging_zero_fill",
    "party_due_buckets",
    "billing_summary",
    "first_sale_item",
    "invoice_balance",
    "agreement_activities",
    "double_billed_items",
    "double_bill_ranked_requests",
    "rank_duplicate_requests",
    "orphan_payment_request_items",
    "bad_installments",
    "missing_request_exclusions",
    "missing_payment_transactions",
    "mispointed_requests",
    "overpaid_invoices",
    "cash_overcredited_invoices",
    "repeat_card_declines",
    "rebill_candidates",
    "error_log_window",
    "create_missing_payment_tx",
    "stop_duplicate_payment_requests",
    "agreement_cascade_plan",
    "removal_dry_run",
    "cascade_apply",
    "invoice_removal_plan",
    "before_images",
    "relink_transactions",
    "removal_apply",
    "refresh_due_amounts",
    "removal_guard",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = session(
        "duesmith-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    T = Tables.from_test_data(spark, sf_dir)
    if os.environ.get("BENCH_STORED") == "1":
        root = new_folder(spark, "bench")
        for name in VIEWS:
            T[name].write.parquet(f"{root}/{name}")
        T = Tables.from_parquet(spark, root)
    chosen = sys.argv[1:] or HEADLINE
    queries = catalog()
    seconds: dict[str, float] = {}
    # The first query of a session pays for class loading; keep that out of the figures.
    queries[chosen[0]].run(T).write.format("noop").mode("overwrite").save()
    for name in chosen:
        runs = []
        for _ in range(rounds):
            start = time.perf_counter()
            # The no-op sink makes every output column count, as a write would.
            queries[name].run(T).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
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
    clear_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
