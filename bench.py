"""Seconds per query; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, default all
BENCH_RUNS     measured runs per query, the best counts (default 1)

Every query is run whole: results go to Spark's no-op sink, which computes all
rows and keeps none. One untimed query first starts the JVM's and Python's parts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.registry import queries  # noqa: E402
from millrace.session import build_session, release_scratch  # noqa: E402

# Analytical queries and load jobs whose sum is the metric.
HEADLINE = (
    "star_sales_by_quarter star_sales_by_quarter_city snowflake_items_by_category distinct_orders_by_year "
    "rank_products rank_stores_by_year scan_csv_infer sink_partition_year_month surrogate_key_full "
    "dim_upsert_rebuild dim_scd2 fact_sales_build layout_hash versioned_merge stream_versioned_sink"
).split()


def run(query, spark, folder: str) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    known = queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(known)
    spark = build_session("bench", cores)
    run(known["star_sales_by_quarter"], spark, folder)
    seconds, failed = {}, {}
    for name in names:
        try:
            seconds[name] = round(min(run(known[name], spark, folder) for _ in range(runs)), 3)
        except Exception as error:
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
        print(f"{name} {seconds.get(name, 'failed')}", file=sys.stderr, flush=True)
    headline = [seconds[n] for n in HEADLINE if n in seconds]
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(headline), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cores": cores,
        "total_all": round(sum(seconds.values()), 3),
    }
    if failed:
        result["failed"] = failed
    release_scratch(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
