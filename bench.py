"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to its last row (a sink that drops the rows), plan building and size checks included. All are warmed up
first; then $BENCH_RUNS rounds run each of them once, so that no query has a part of the session to itself, and the
median counts. "control" is a fixed amount of work that no code of this repository takes part in: the machine's speed.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aeroband.session import build_session
from checks import registered

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "station_summary", "daily_index", "nearest_weather", "nearest_weather_collapsed", "nearest_weather_grid",
    "dedupe_latest_readings", "dedupe_latest_orders", "conditional_pivot", "band_index_lineitem", "standard_labels",
    "nearby", "stations_min_index", "series_json_explode", "parallel_arrays_flatten", "quality_report",
]


def run(spark, name):
    start = time.perf_counter()
    registered.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            # The tables are megabytes: at the default of 1 MB, stages would run on one or two cores.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs = {name: [] for name in names}
    controls = []
    for number in range(RUNS + 1):
        for name in names:
            taken = run(spark, name)
            if number:
                runs[name].append(taken)
        start = time.perf_counter()
        spark.range(30_000_000).selectExpr("sum(hash(id) % 1000)").collect()
        if number:
            controls.append(time.perf_counter() - start)
    seconds = {name: round(statistics.median(taken), 3) for name, taken in runs.items()}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "control": round(statistics.median(controls), 3),
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
