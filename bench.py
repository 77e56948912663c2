"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES, tuned  # noqa: E402

HEADLINE = [
    "gold_fact_sales_summary",
    "gold_dim_customer_enriched",
    "gold_agg_daily_sales",
    "gold_agg_product_performance",
    "gold_publish",
    "zorder_preserves_rows",
    "scd2_events",
    "scd2_orders",
    "scd2_tracked",
    "scd1_latest",
    "dedup_latest",
    "change_feed",
    "conform_types",
    "clean_rows",
    "quality_items",
    "quality_counts",
    "extract_incremental",
    "ingest_full",
    "ingest_incremental",
    "stream_append_orders",
    "stream_loads_orders",
    "stream_scd2_events",
    "stream_scd2_batches",
    "stream_scd1_batches",
    "history_change_feed",
    "payment_rollup",
    "sample_by_date",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {n: tuned(QUERIES[n]) for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]}

    def run(query) -> float:
        start = time.perf_counter()
        query(spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # One session, warmed up by a pass over all queries; then the median of the runs of each.
    for query in chosen.values():
        run(query)
    seconds = {}
    for name, query in chosen.items():
        run(query)
        seconds[name] = round(statistics.median(run(query) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
