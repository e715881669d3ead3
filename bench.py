"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run twice into the no-op sink and the faster run counts.
``rows_per_sec`` relates the rows a load reads to its time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mirrorspan.registry import QUERIES, Inputs
from mirrorspan.session import local_session

HEADLINE = (
    "scan_query", "scan_key_pages", "column_catalog", "row_counts", "table_info",
    "lookback_single", "lookback_multi", "lookback_null_guard", "lookback_timestamp",
    "child_window_semi", "child_window_join", "child_window_two_hop",
    "delete_window", "delete_child_window", "window_replace_parent", "window_replace_child",
    "run_incremental_final", "full_refresh", "append_load", "rebuild_verify", "layout_roundtrip",
    "type_mapping", "cast_to_mapped", "cast_reject_count", "clean_text", "null_token_counts",
    "duration_to_time", "evolve_union", "schema_reconcile", "precision_loss_counts",
    "join_test", "join_test_all", "fk_orphans", "join_composite_key", "common_columns",
    "sync_plan", "missing_tables", "count_parity", "sync_drift", "freshness", "column_quality",
    "ledger_summary", "largest_tables", "view_invoices_consolidated", "view_daily_sales",
    "view_stock_union", "view_product_master", "view_order_tracking",
    "stream_append_final", "stream_window_replace_final",
)
# Load queries and the tables whose rows they read.
LOADS = {
    "window_replace_child": ("lineitem", "orders"),
    "run_incremental_final": ("lineitem", "orders"),
    "full_refresh": ("orders",),
    "rebuild_verify": ("lineitem",),
    "clean_text": ("documents",),
    "view_invoices_consolidated": ("lineitem", "orders"),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or [q for q in HEADLINE if q in QUERIES]
    inputs = Inputs(spark, folder)
    inputs("orders").groupBy("o_orderstatus").count().collect()  # starts the workers

    seconds = {}
    for name in names:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    rows = {
        name: round(sum(inputs(t).count() for t in tables) / seconds[name])
        for name, tables in LOADS.items()
        if name in seconds
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rows_per_sec": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
