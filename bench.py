"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of all timed steps), "unit",
"queries": {name: seconds}, "first_run_total", "repeat", "sf"}. Each query
runs $BENCH_REPEAT times (default 3) and reports its median; the total of
first runs is given too. ``ingest_raw`` is the landing of the raw
layer, ``build_models`` the model build (staging and the city-day table); every query is then fully executed through the no-op sink (no
collect to the driver). A warm-up run on sf0.001 keeps JVM start-up out.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cityair import build_session  # noqa: E402
from cityair.catalog import QUERIES, world  # noqa: E402

REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

HEADLINE = [
    "stg_air_quality", "city_daily_avg", "pollution_ranking", "top10_pm25",
    "kpi_summary", "pm25_alerts", "merge_upsert", "flatten_locations", "bbox_match",
    "tagged_stations", "capital_survey", "monthly_top15", "map_frames", "dq_suite",
    "quality_profile", "city_daily_confidence",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "8g"})

    def run(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Warm-up on the smallest folder so JVM start-up and code generation
    # are not billed to the first query.
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm) and warm != sf_dir:
        QUERIES["top10_pm25"](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    # Ingestion: derive the raw layer from the test tables and land it as
    # Parquet (what the models read), timed on its own.
    t0 = time.perf_counter()
    w = world(spark, sf_dir)
    w.land()
    times["ingest_raw"] = round(time.perf_counter() - t0, 3)
    # Model build: staging landed, then the city-day table the marts and
    # serving queries read.
    t0 = time.perf_counter()
    w.build_models()
    times["build_models"] = round(time.perf_counter() - t0, 3)
    first = {}
    for name in names:
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            run(name)
            runs.append(time.perf_counter() - t0)
        first[name] = runs[0]
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "first_run_total": round(sum(first.values()) + times["ingest_raw"]
                                               + times["build_models"], 3),
                      "repeat": REPEAT, "cpus": int(cpus),
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
