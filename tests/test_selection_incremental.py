"""Exact quantiles, ranks in ranges, and the refresh of the city-day table."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityair import flow, schemas
from cityair.operators import merge, selection
from cityair.plans import incremental, marts, serving, staging
from cityair.sources import seeds, sinks, standins as S
from conftest import SF0001, SF001

PROBS = (0.0, 0.25, 0.5, 0.95, 0.98, 1.0)


def quantiles(df, probs=PROBS, **k):
    rows = selection.exact_quantiles(df, ["g"], "x", probs, **k).collect()
    return {r.g: (r.n, list(r.q)) for r in rows}


def percentiles(df, probs=PROBS):
    rows = df.groupBy("g").agg(F.count("x").alias("n"), F.percentile(
        "x", F.array(*[F.lit(p) for p in probs])).alias("q")).where("n > 0").collect()
    return {r.g: (r.n, list(r.q)) for r in rows}


def shapes():
    rng = np.random.default_rng(4)
    return {
        "wide": (10.0 ** rng.uniform(-200, 200, 900) * rng.choice([-1, 1], 900)).tolist(),
        "two": [1.0] * 500 + [2.0] * 500,          # the bracket's ends hold all rows
        "third": [5.0] * 400 + rng.normal(size=800).tolist(),
        "same": [7.0] * 800, "few": [3.0, 1.0], "one": [9.0],
        "infinite": [-math.inf, math.inf] + rng.normal(size=500).tolist(),
        None: rng.uniform(size=500).tolist(),
    }


@pytest.fixture(scope="module")
def values(spark):
    rows = [(g, x, "extra") for g, xs in shapes().items() for x in xs]
    rows += [("few", None, ""), ("nulls", None, "")]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, x double, v string").repartition(3).cache()


def test_quantiles_equal_percentile(values, monkeypatch):
    want = percentiles(values)
    assert "nulls" not in want and len(want) == 8
    assert quantiles(values) == want                       # gathered at once
    whole, seen = F.sort_array, []

    def bounded(c, *a):
        seen.append(c)
        return F.when(F.size(c) > 40, F.raise_error(F.lit("too many in a task"))).otherwise(whole(c))
    monkeypatch.setattr(selection.F, "sort_array", bounded)
    assert quantiles(values, gather=40) == want and seen   # brackets of brackets


def test_sketch_only_steers(values, monkeypatch):
    """However coarse the sketch, the quantiles are exact."""
    monkeypatch.setattr(selection, "ACCURACY", 3)
    monkeypatch.setattr(selection, "GRID", 8)
    some = values.where("g IN ('third', 'two')")
    assert quantiles(some, (0.5, 0.97), gather=100) == percentiles(some, (0.5, 0.97))


def test_quantiles_without_groups_or_rows(spark, values):
    assert quantiles(values.limit(0)) == {}
    whole = selection.exact_quantiles(values, [], "x", (0.5,), gather=50).first()
    want = values.agg(F.percentile("x", F.lit(0.5))).first()[0]
    assert whole.q == [want] and whole.n == values.where("x IS NOT NULL").count()


def test_colour_caps_take_either_way(values):
    monthly = values.where("g IN ('third', 'two', 'one')").select(
        F.col("g").alias("parameter"), F.col("x").alias("avg_value"))
    read = lambda df: {r.parameter: (r.cmax, r.xmax) for r in df.collect()}
    plain = read(serving.colour_caps(monthly).where("cmax IS NOT NULL"))
    assert read(serving.colour_caps(monthly, max_rows=10, gather=300)) == plain


def windowed(df):
    from pyspark.sql import Window
    w = Window.partitionBy("g").orderBy(F.desc_nulls_first("x"))
    return sorted(((r.g is None, str(r.g), r.x is None, r.x or 0.0, r.r) for r in df.withColumn(
        "r", F.rank().over(w)).collect()))


@pytest.mark.parametrize("size", [20, 100_000])
def test_ranks_in_ranges_equal_the_window(values, size):
    """Ties far larger than a range, NULLs first, a group of NULLs, a NULL group."""
    extra = values.unionByName(values.where("g = 'third'").limit(90).select(
        "g", F.lit(None).cast("double").alias("x"), "v"))
    got = selection.ranked(extra, ["g"], "x", "r", size)
    assert got.columns == ["g", "x", "v", "r"] and dict(got.dtypes)["r"] == "int"
    assert sorted((r.g is None, str(r.g), r.x is None, r.x or 0.0, r.r)
                  for r in got.collect()) == windowed(extra)


def test_ranks_of_no_rows(values):
    assert selection.ranked(values.limit(0), ["g"], "x", "r").collect() == []


def test_ranking_beyond_the_bound_has_no_window_over_a_pollutant(spark):
    cda = spark.createDataFrame(
        [(f"c{i}", "X", "pm25" if i % 3 else "no2", None if i % 50 == 0 else float(i % 40),
          float(i)) for i in range(400)],
        "city string, country string, parameter string, avg_value double, max_value double")
    plain = marts.pollution_ranking(cda)
    ranges = marts.pollution_ranking(cda, max_window_rows=10, range_rows=6)
    assert sorted(map(str, plain.collect())) == sorted(map(str, ranges.collect()))
    plan = ranges._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" not in plan and plan.count("windowspecdefinition(parameter#") <= 2
    assert "rank(" in plain._jdf.queryExecution().optimizedPlan().toString()


# ---- refresh of the city-day table ----

def frames(spark, sf=SF001):
    return (S.readings(spark, sf), S.sensors(spark, sf), S.locations(spark, sf),
            seeds.molecular_weights(spark))


def fact_of(spark, path, batch):
    sinks.upsert_partitions(batch, path, ["sensor_id", "date_utc"], "month",
                            merge.month_of("date_utc"))
    return spark.read.parquet(path)


def rows_of(df):
    return sorted(map(str, df.select(*schemas.CITY_DAILY_AVG.fieldNames()).withColumn(
        "avg_value", F.round("avg_value", 9)).collect()))


def full(fact, sensors, locations, weights):
    return marts.city_daily_avg(staging.stg_air_quality(fact, sensors, locations, weights))


def test_increments_equal_the_full_build(spark, scratch):
    readings, sensors, locations, weights = frames(spark)
    fact, table = scratch + "/fact", scratch + "/table"
    days = [F.lit(f"2024-01-{d:02d}").cast("timestamp") for d in (8, 16, 24)]
    at = F.col("ingested_at")
    parts = [at < days[0], (at >= days[0]) & (at < days[1]),
             (at >= days[1]) & (at < days[2]), at >= days[2]]
    for i, cond in enumerate(parts):
        batch = readings.where(cond)
        measured = fact_of(spark, fact, batch)
        if i == 0:
            incremental.build(measured, sensors, locations, weights, table)
        else:
            touched = incremental.touched_by_readings(batch, sensors, locations)
            assert incremental.refresh(touched, measured, sensors, locations, weights, table)
        assert rows_of(incremental.read(spark, table)) == rows_of(
            full(measured, sensors, locations, weights))
    assert {p for p in os.listdir(table) if p.startswith("month=")} == {"month=2024-01"}


def reading_row(sensor, day, value, parameter="pm25", ts="2024-02-01", pct=100.0):
    return (sensor, day, value, parameter, "µg/m³", pct, ts)


def batch_rows(spark, rows):
    df = spark.createDataFrame(rows, "sensor_id long, date_utc string, value_avg double, "
                                     "parameter_name string, parameter_units string, "
                                     "percent_complete double, ingested_at string")
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                      else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in schemas.MEASUREMENTS_DAILY.fields])
    return out.withColumn("value_max", F.col("value_avg"))


def places(spark, city_of):
    locs = spark.createDataFrame([(i, c, f"land of {c}" if c != "Null" else None)
                                  for i, c in city_of.items()],
                                 "location_id long, capital_name string, country_name string")
    sens = spark.createDataFrame([(10 * i + 1, i) for i in city_of],
                                 "sensor_id long, location_id long")
    return sens, locs


def test_changed_pollutant_and_unusable_value_leave_their_old_rows(spark, scratch):
    weights = seeds.molecular_weights(spark)
    sens, locs = places(spark, {1: "A", 2: "B", 3: "Null"})
    fact, table = scratch + "/fact", scratch + "/table"
    first = batch_rows(spark, [
        reading_row(11, "2024-01-01", 5.0), reading_row(21, "2024-01-01", 7.0),
        reading_row(21, "2023-12-31", 9.0, "no2"), reading_row(31, "2024-01-01", 2.0),
        reading_row(11, "2023-11-05", 4.0)])
    incremental.build(fact_of(spark, fact, first), sens, locs, weights, table)
    second = batch_rows(spark, [
        reading_row(11, "2024-01-01", 5.0, "o3", ts="2024-03-01"),      # another pollutant
        reading_row(21, "2023-12-31", -1.0, "no2", ts="2024-03-01"),    # no longer usable
        reading_row(31, "2024-01-01", 3.0, ts="2024-03-01"),            # a NULL country
        reading_row(99, "2024-01-01", 3.0, ts="2024-03-01")])           # an unknown sensor
    measured = fact_of(spark, fact, second)
    months = incremental.refresh(incremental.touched_by_readings(second, sens, locs), measured,
                                 sens, locs, weights, table)
    assert months == ["2023-12", "2024-01"]
    got = incremental.read(spark, table)
    assert rows_of(got) == rows_of(full(measured, sens, locs, weights))
    assert {(r.city, r.parameter, r.avg_value) for r in got.collect()} == {
        ("A", "o3", 5.0), ("B", "pm25", 7.0), ("Null", "pm25", 3.0), ("A", "pm25", 4.0)}
    # The month without rows is gone, the untouched one was not written again.
    assert not os.path.exists(f"{table}/month=2023-12/parameter=no2")


def test_untouched_months_keep_their_files(spark, scratch):
    weights = seeds.molecular_weights(spark)
    sens, locs = places(spark, {1: "A"})
    fact, table = scratch + "/fact", scratch + "/table"
    first = batch_rows(spark, [reading_row(11, f"2024-{m:02d}-01", 1.0) for m in range(1, 7)])
    incremental.build(fact_of(spark, fact, first), sens, locs, weights, table)
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(table) for f in fs
                     if f.endswith(".parquet")}
    before = files()
    second = batch_rows(spark, [reading_row(11, "2024-03-02", 2.0, ts="2024-08-01")])
    measured = fact_of(spark, fact, second)
    days = incremental.touched_by_readings(second, sens, locs)
    assert incremental.refresh(days, measured, sens, locs, weights, table) == ["2024-03"]
    assert {f.split("month=")[1][:7] for f in before ^ files()} == {"2024-03"}
    plan = incremental.refreshed(days, ["2024-03"], ("2024-03-02", "2024-03-02"), measured, sens,
                                 locs, weights, incremental.read(spark, table))
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in text.splitlines() if "FileScan" in ln and "month" in ln]
    assert len(scans) == 2
    assert all("PartitionFilters: [isnotnull(month" in ln and "2024-03" in ln for ln in scans)
    again = incremental.refresh(days, measured, sens, locs, weights, table)  # a retry
    assert again == ["2024-03"] and rows_of(incremental.read(spark, table)) == rows_of(
        full(measured, sens, locs, weights))


def test_station_that_moves_refreshes_both_cities(spark, scratch):
    weights = seeds.molecular_weights(spark)
    sens, old = places(spark, {1: "A", 2: "A", 3: "B"})
    _, new = places(spark, {1: "A", 2: "C", 3: "B"})
    fact, table = scratch + "/fact", scratch + "/table"
    measured = fact_of(spark, fact, batch_rows(spark, [
        reading_row(s, f"2024-{m:02d}-01", float(s + m)) for s in (11, 21, 31) for m in (1, 2, 3)]))
    incremental.build(measured, sens, old, weights, table)
    dims = [staging.sensor_cities(sens, x) for x in (old, new)]
    days = incremental.touched_by_stations(measured, *dims)
    assert {r.city for r in days.collect()} == {"A", "C"}
    incremental.refresh(days, measured, sens, new, weights, table)
    assert rows_of(incremental.read(spark, table)) == rows_of(full(measured, sens, new, weights))
    none = incremental.touched_by_stations(measured, dims[1], dims[1])
    assert incremental.refresh(none, measured, sens, new, weights, table) == []


def test_streamed_loads_refresh_the_table(spark, scratch):
    """Landed files -> stream with refresh = one full build over all of them."""
    land, raw, table = f"{scratch}/land", f"{scratch}/raw", f"{scratch}/table"
    S.country_payloads(spark, SF0001).write.json(land + "/countries")
    S.location_payloads(spark, SF0001, False).write.json(land + "/locations")
    env = S.day_envelopes(spark, SF0001)
    at, cut = F.col("ingested_at"), F.lit(S.SPLIT_TS).cast("timestamp")
    ts = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    env.where(at < cut).write.options(**ts).json(land + "/first")
    flow.ingest(spark, land + "/countries", land + "/locations", land + "/first", raw,
                S.RUN_TS, S.AS_OF)
    flow.build_incremental(spark, flow.read_raw(spark, raw), table)
    env.where(at >= cut).repartition(2).write.options(**ts).json(land + "/days")
    flow.stream_days(spark, land + "/days", raw, f"{scratch}/ckpt", S.RUN_TS,
                     max_files_per_trigger=1, table_path=table)
    state = flow.read_raw(spark, raw)
    want = full(state["measurements"], state["sensors"], state["locations"],
                seeds.molecular_weights(spark))
    got = incremental.read(spark, table)
    assert rows_of(got) == rows_of(want) and got.count() > 0
