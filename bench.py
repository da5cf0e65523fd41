"""Times the headline reports: one warm-up run and one timed run each; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (names, comma list, or `all`).
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.session import session
from millrace.reports.registry import callables
import millrace.reports  # noqa: F401

HEADLINE = [
    "usage_by_category", "group_sums", "list_filter_join", "not_in_returns", "tuple_anti", "like_pattern_anti", "exists_semi", "asof_history",
    "interval_overlap", "code_range_join", "price_range_join", "tolerance_join", "computed_key_join", "self_join_same_day", "scalar_factor",
    "dense_grid", "waterfall_sources", "match_fallback", "offset_pairs", "allocate_shared_pool", "moving_average_units", "product_sales",
    "keep_first_last", "listagg_ordered", "listagg_distinct", "split_regroup", "count_distinct_mix", "duplicate_keys", "subtotals_averages",
    "conditional_kpis", "kpi_matrix_pivot", "plan_mix_share", "signed_contribution", "dedup_latest", "first_row", "second_row", "nested_dedup",
    "rank_ties", "dwell_time", "movement_path", "drop_repeats", "predicates", "date_repair", "contract_value", "retention_upgrade", "row_key",
    "json_fields", "update_rules", "events_per_day", "service_revenue", "product_class_sales", "campaign_kpi_matrix", "bill_offsets",
    "commission_base", "commission_value", "commission_exceptions", "channel_transactions", "channel_addons", "channel_typing", "channel_attribution",
    "addon_fees", "campaign_classify", "store_staff_summary", "contribution_by_store", "contribution_by_staff", "bill_standing", "wide_column_view",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    reports = callables()
    names = list(reports) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = session("bench")
    times: dict[str, float] = {}
    for name in names:
        run(reports[name](spark, sf_dir))
        began = time.perf_counter()
        run(reports[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total warm time of headline reports", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
