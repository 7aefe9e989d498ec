"""Benchmark: prints one JSON line with seconds per headline query.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline set)

Each query runs once cold and then warm; the warm time is reported. Results go
to Spark's no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans import REGISTRY, run  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "v1_executive_daily", "v2_executive_overview", "v3_customer_360", "a8_executive_kpis",
    "q001_dedup_latest", "q003_rank_metric", "q007_decile_by_value", "q010_moving_average", "q013_topn_per_group", "q015_percent_position",
    "q018_iqr_outliers", "q019_rfm_segments", "q025_indirect_reports", "q032_cube_gmv", "q035_pivot_region_weekly", "q041_not_engaged",
    "q045_json_explode_items", "q050_json_key_counts", "q055_star_join", "q057_asof_scd2_join", "q060_rapid_repeat", "q062_reconcile",
    "q069_volume_drift", "q074_alert_queue", "q078_pnl_bridge", "q082_service_slo", "q085_cost_by_layer", "q104_null_spike",
    "m1_daily_gmv_by_bu", "l1_scd2_customer", "d11_run_checks", "g7_downstream", "r3_hourly_events",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    run(name, spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = local_session("bench", cpus)
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(seconds(spark, name, folder), 3)
        warm[name] = round(seconds(spark, name, folder), 3)
    line = {
        "metric": "total_warm_query_seconds", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": folder.rsplit("sf", 1)[-1], "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
