"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query's full result is computed and discarded by the no-op sink. Each is run twice and the
better time counts, as the first run also pays for class loading and code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from registry.queries import QUERIES
from tradewind.session import build_session

HEADLINES = [
    "log_split_counts", "log_page", "log_display", "log_action", "log_start", "log_error",
    "cdc_fact_route", "dim_latest", "dau_dedup", "dau_wide", "dau_by_day", "dau_by_hour",
    "dau_daily_partitions", "order_enriched", "order_full_outer", "order_wide", "order_unmatched",
    "detail_unmatched", "order_amount_by_gender", "order_amount_by_age_band", "order_amount_by_province",
    "order_item_search", "bulk_upsert", "update_by_id", "delete_by_id", "search_filter",
    "search_total_hits", "terms_avg_topk", "offset_ledger", "stream_log_split", "stream_dau_dedup",
    "stream_dau_wide", "stream_order_join", "stream_change_routing", "stream_restart", "stream_new_checkpoint",
    "stream_dau_dedup_bounded", "dau_funnel_counts", "keyed_sink_layout", "alias_all_days", "order_mapping_cast",
    "stream_dau_changing_dims", "stream_order_new_checkpoint", "stream_unmatched",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        times = []
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
