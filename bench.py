"""Headline queries at one scale; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "word_count", "running_count_by_key", "retract_changelog", "keyed_basic_aggs", "agg_state_merge", "bitmap_distinct",
    "tumbling_time_keyed", "sliding_avg_keyed", "sliding_top_bottom_all", "count_window_keyed", "count_window_all",
    "session_window_all", "session_window_keyed", "bounded_out_of_order_window", "allowed_lateness_refire", "per_partition_watermark",
    "state_ttl_counter", "dedup_first_seen_ttl", "dedup_with_dup_count", "trade_totals", "lookup_static", "lookup_config_stream",
    "replacing_latest", "summing_columns", "collapsing", "versioned_collapsing", "incremental_mv_merged",
    "cells_put", "cells_long_wide", "scan_range", "pack_record", "parse_json_fields", "fn_ipv4",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from weirflow.plans import QUERIES
    from weirflow.session import build_session

    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for key in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[key] = round(statistics.median(runs), 3)
        print(f"{key} {times[key]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
