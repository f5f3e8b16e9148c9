"""Time the headline queries, warm, and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
cores, BENCH_RUNS the timed runs per query after two warm-ups.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripweave.plans.queries import QUERIES  # noqa: E402
from tripweave.session import build_session  # noqa: E402

WARM_UPS = 2

HEADLINE = [
    "monthly_stats",
    "yearly_totals",
    "file_row_counts",
    "column_presence",
    "conform_schema",
    "clean_all",
    "clean_job_summary",
    "epoch_normalise",
    "timestamp_sample",
    "trip_ids",
    "trip_ids_split",
    "zone_lookup_default",
    "zone_medians",
    "reproject",
    "event_counts",
    "event_timeline",
    "event_order",
    "event_positions",
    "event_payloads",
    "event_messages",
    "decode_events",
    "feed_metrics",
    "feed_stream",
]


def timed(spark, name: str, sf_dir: str) -> float:
    """Build the query and compute every row of it, without collecting them."""
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus if cpus.isdigit() else "8",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(WARM_UPS):
            timed(spark, name, sf_dir)
        times = [timed(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    result = {
        "metric": "total seconds of the headline queries (warm, median)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
