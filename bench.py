"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the local cores. Every query is planned and run once into the no-op sink,
after one small warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "event_log_slice",
    "decode_json_events",
    "quarantine_summary",
    "coalesce_latest",
    "upsert_two_batches",
    "append_ignore",
    "proj_cm_state",
    "proj_logistics_status",
    "proj_telemetry_latest",
    "proj_tactical_events",
    "proj_telemetry_windows",
    "proj_region_top_factors",
    "proj_capability_state",
    "proj_element_telemetry",
    "proj_inventory",
    "join_nearest_site",
    "join_longest_prefix",
    "join_longest_prefix_table",
    "join_longest_prefix_blocked",
    "consumer_lag",
    "fallback_throttle",
    "stream_upsert",
    "stream_append_ignore",
    "changelog_compaction",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("readmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # The test files are small: split them so that all cores take part.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["consumer_lag"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
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


if __name__ == "__main__":
    main()
