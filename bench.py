"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. A query's
result is read in full and discarded. ``BENCH_REPEATS`` runs each query several times
and keeps the best. Layers that several queries read are written once a session: the
time to write all of them, measured once on the empty session, is the entry ``layers`` and
part of the sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from wattspindle.plans.catalog import LAYERS, QUERIES
from wattspindle.session import create_session

HEADLINE = [
    "telemetry_window_15min",
    "telemetry_window_rollup",
    "price_hourly_resample",
    "price_forward_fill_15min",
    "harmonize_mean_fill",
    "harmonize_ffill",
    "monthly_index_join",
    "silver_enriched",
    "machine_daily_metrics",
    "machine_daily_fact",
    "machine_summary",
    "fleet_kpis",
    "daily_vs_average",
    "dataset_inventory",
    "quality_nulls",
    "run_summary",
    "signal_chunk_rms",
    "signal_samples",
    "chunk_ordinals",
    "filename_parse",
    "message_parse",
    "price_xml_parse",
    "stream_window_append",
    "stream_window_update",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = create_session("bench", cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    for build in LAYERS.values():
        build(spark, sf_dir)
    timings: dict[str, float] = {"layers": round(time.perf_counter() - began, 3)}
    print(f"layers {timings['layers']}", file=sys.stderr)
    for name in HEADLINE:
        timings[name] = round(min(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
