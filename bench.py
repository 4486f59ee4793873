"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "freshness_outcomes", "latest_per_key", "record_caps", "upsert_changed", "snapshot_diff", "failure_prefix",
    "code_array_lookup", "sheet_forward_fill", "sheet_parse", "canonical_grant", "validate_errors",
    "publish_outcomes", "mail_trust", "metric_rollup", "metric_formula", "alert_error_ratio", "alert_stale",
    "route_paths",
]


def main() -> None:
    from grantflow.queries import REGISTRY
    from grantflow.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the engine before the clock, and run every query once on the smallest tables where there are any
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    least = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(least):
        for name in HEADLINE:
            REGISTRY[name].run(spark, least).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.time()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
