"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores,
BENCH_RUNS the timed runs per query (their median counts; one run before them is not timed).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from waymill.registry import QUERIES
from waymill.session import local_session

HEADLINES = (
    "cheapest_offer_per_key",
    "offer_schedule_join",
    "cheapest_itineraries",
    "airport_names_both_ends",
    "carrier_name_lookup",
    "code_name_pairs",
    "nested_leg_flatten",
    "nested_offer_flatten",
    "fare_type_pick",
    "map_entries",
    "target_filter",
    "two_direction_union",
    "branch_counts",
    "daily_operations_job",
    "incremental_append",
    "incremental_per_key",
    "missing_partitions",
    "fill_mean",
    "fill_mode_null_group",
    "weather_batch_clean",
    "column_profile",
    "column_profile_wide",
    "fare_documents_to_itineraries",
    "nested_json_scan",
    "daily_csv_scan",
    "csv_headers_apart",
    "forecast_job",
    "parquet_append_roundtrip",
    "csv_export_roundtrip",
)


def timed(spark, query, folder: str) -> float:
    """Seconds to plan the query and compute every row and column of its result."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds, first = {}, {}
    for name in names or HEADLINES:
        first[name] = round(timed(spark, QUERIES[name], folder), 3)
        seconds[name] = round(statistics.median(timed(spark, QUERIES[name], folder) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)/?$", folder)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
