"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.  Every
query is computed in full (all rows, all columns) into a sink that drops them.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tidewell.catalogue import registered
from tidewell.session import build_session

HEADLINES = [
    "silver_products",
    "silver_users",
    "silver_plans",
    "silver_subscriptions",
    "silver_subscription_changes",
    "silver_payments",
    "silver_license_keys",
    "silver_license_allocations",
    "silver_support_tickets",
    "silver_usage_events",
    "silver_payments_quarantine",
    "quality_report_payments",
    "dedup_latest_kept",
    "dedup_latest_dropped",
    "multi_fk_flags",
    "role_playing_fk",
    "validation_error_text",
    "upsert_newer",
    "upsert_composite",
    "surrogate_keys",
    "previous_status",
    "fx_convert",
    "risk_marking",
    "seat_expand",
    "session_rollup",
    "churn_rate",
    "nrr",
    "revenue",
    "landing_stream",
    "landing_to_bronze",
    "upsert_lake",
    "foreach_batch_upsert",
    "publish_subscriptions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    queries["silver_subscriptions"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        begun = time.perf_counter()
        queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    result = {
        "metric": "total wall-clock of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
