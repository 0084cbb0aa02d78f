"""

Replicates the sf0.1 raw layer (readings shifted by 31 days per copy,
stations offset in id) under the session's checkpoint folder and times the
heavy plans on it; prints one JSON line. Usage:
``python scale_bench.py [fact_copies=80] [station_copies=100]``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cityair import build_session  # noqa: E402
from cityair.catalog import world  # noqa: E402
from cityair.operators import geo  # noqa: E402
from cityair.operators.merge import month_of  # noqa: E402
from cityair.plans import marts, staging  # noqa: E402
from cityair.plans.models import build_models  # noqa: E402
from cityair.sources import sinks, standins as S  # noqa: E402


def _timed(f, repeat=2):
    best = None
    for _ in range(repeat):
        t0 = time.perf_counter()
        f()
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    return round(best, 2)


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    fact_copies = int(sys.argv[1]) if len(sys.argv) > 1 else 80
    station_copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(f"local[{os.environ.get('BENCH_CPUS', '8')}]",
                          extra={"spark.driver.memory": "8g"})
    w = world(spark, sf_dir)
    out = {"fact_copies": fact_copies, "station_copies": station_copies}

    copy = F.explode(F.sequence(F.lit(0), F.lit(fact_copies - 1))).alias("__k")
    fact = (w.measurements.drop("month").select("*", copy)
            .withColumn("date_utc", F.col("date_utc") + F.make_dt_interval(F.col("__k") * 31))
            .drop("__k"))
    fact = sinks.materialize(fact.repartition(16), "scale_fact")
    out["fact_rows"] = fact.count()
    out["stg_to_city_daily_s"] = _timed(lambda: _noop(marts.city_daily_avg(
        staging.stg_air_quality(fact, w.sensors, w.locations, w.weights))))

    def model_build():
        m = build_models(fact, w.sensors, w.locations, w.weights)   # writes the table
        for view in (m.city_pollution_ranking, m.kpi_summary, m.who_pm25_alerts):
            _noop(view)
    out["model_build_s"] = _timed(model_build)

    scopy = F.explode(F.sequence(F.lit(0), F.lit(station_copies - 1))).alias("__k")
    st = S.stations(spark, sf_dir)
    st = sinks.materialize(st.select("*", scopy).withColumn(
        "location_id", F.col("location_id") * station_copies + F.col("__k")).drop("__k")
        .repartition(16), "scale_stations")
    caps = w.capitals
    out["stations"] = st.count()
    out["bbox_match_s"] = _timed(lambda: _noop(geo.bbox_match(caps, st)))
    out["tag_stations_s"] = _timed(lambda: _noop(geo.tag_stations(caps, st, S.AS_OF)))

    table = sinks.scratch_path(spark, "scale_upsert")
    keys = ["sensor_id", "date_utc"]
    t0 = time.perf_counter()
    sinks.upsert_partitions(fact, table, keys, "month", month_of("date_utc"))
    out["upsert_first_load_s"] = round(time.perf_counter() - t0, 2)
    batch = (w.measurements.drop("month")
             .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")))
    out["upsert_one_month_s"] = _timed(
        lambda: sinks.upsert_partitions(batch, table, keys, "month", month_of("date_utc")))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
