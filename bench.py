"""Time the headline queries, each after one warm-up run, and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from salesops.plans.registry import QUERIES
from salesops.session import local_session

HEADLINE = [
    "monthly_price_and_sales",
    "slow_items_by_month",
    "running_month_total_selfjoin",
    "running_month_total_window",
    "top2_items_by_month",
    "item_functions",
    "last_customer_by_seller",
    "top2_purchases_by_customer",
    "top2_prices_by_customer_apply",
    "customer_month_pivot",
    "customer_month_pivot_dynamic",
    "large_invoices_with_picked_total",
    "cities_of_dearest_items",
    "invoices_of_customer",
    "invoices_of_customers",
    "cross_billing_original",
    "tuned_cross_billing",
    "merge_parties",
    "delimited_roundtrip",
    "xml_shred",
    "json_tag_filter",
    "posting_reconcile",
    "line_tiles",
    "report_requests_batch",
]


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    times: dict[str, float] = {}
    for name in wanted:
        run(spark, name, sf_dir)
        times[name] = round(run(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "total seconds of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
