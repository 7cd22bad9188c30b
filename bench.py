"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up, then $BENCH_RUNS times (default 3) into the
no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from geoloom.plans.catalog import QUERIES
from geoloom.session import local_session

HEADLINE = [
    "make_points_wkb",
    "decode_wkb_points",
    "decode_wkb_lines",
    "make_lines",
    "make_lines_long_keys",
    "make_lines_hot_keys",
    "encode_wkb_lines",
    "parse_geojson_events",
    "parse_geojson_polygons",
    "check_validity_polygons",
    "collect_multi_lines",
    "convert_wkb_to_ewkb",
    "audit_roundtrip",
    "quality_report",
    "ingest_geojson",
]


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    times = {}
    for name in HEADLINE:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))


if __name__ == "__main__":
    main()
