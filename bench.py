"""Time the registered queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakeweave.catalog import CATALOG  # noqa: E402
from lakeweave.session import build_session  # noqa: E402

HEADLINE = """layered_daily_revenue status_counts signed_net_by_priority kpi_conditional_daily category_revenue segment_revenue
customer_360 daily_sales_top_product product_performance global_kpis category_analysis column_profile order_metrics
enrich_match_flags lookup_default upsert_merge unique_with_count business_key_dedup sort_then_unique top_k_per_month
latest_by_key last_n_trail latest_with_ties running_total rolling_hour flag_duplicates dedup_with_quarantine
tumbling_window hopping_window session_window cdc_replay_current cdc_classify cdc_normalise changelog_table schema_drift
quality_errors expectation_counts dead_letter_rows batch_score dataset_rules stage_metrics box_join box_density
latest_snapshot_lookup bucket_summary threshold_correlation threshold_alerts nearest_centre surge_by_zone
layered_order_facts layered_product_kpis retail_lake_counts stream_route stream_tumbling stream_sessions
stream_message_upsert stream_trail_state""".split()


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    CATALOG["status_counts"].run(spark, root).collect()  # start the JVM's lazy parts once
    seconds = {}
    for name in names:
        started = time.perf_counter()
        CATALOG[name].run(spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(root).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
