"""Plan shape: pushdown, pruning, broadcasts, partition pruning, no Python UDFs."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from cityair import schemas
from cityair.catalog import QUERIES, world
from cityair.plans import marts, staging
from cityair.sources import seeds, sinks
from conftest import SF0001


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _raw_tables(spark, folder):
    """Write the stand-in raw tables as Parquet, like the landed raw layer."""
    w = world(spark, SF0001)
    for name, df in (("measurements", w.measurements), ("sensors", w.sensors),
                     ("locations", w.locations)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return tuple(spark.read.parquet(f"{folder}/{n}") for n in ("measurements", "sensors", "locations"))


def test_staging_pushes_filters_and_prunes_columns(spark, scratch):
    m, s, l = _raw_tables(spark, scratch)
    stg = staging.stg_air_quality(m, s, l, seeds.molecular_weights(spark))
    plan = _plan(stg)
    scan = plan[plan.index("measurements]"):]
    pushed = scan[scan.index("PushedFilters"):].splitlines()[0]
    for f in ("IsNotNull(value_avg)", "GreaterThanOrEqual(value_avg,0.0)",
              "LessThan(value_avg,10000.0)", "GreaterThanOrEqual(percent_complete,75.0)"):
        assert f in pushed
    read = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "value_median" not in read and "date_local" not in read
    assert "IsNotNull(capital_name)" in plan  # the city rule reaches the station scan
    assert "BroadcastHashJoin" in plan  # small dimensions and the seed are broadcast
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_parameter_partition_pruning_through_ranking(spark, scratch):
    w = world(spark, SF0001)
    path = os.path.join(scratch, "cda")
    sinks.write_table(w.cda, path, partition_by=("parameter",))
    cda = sinks.read_table(spark, path, schemas.CITY_DAILY_AVG)
    top = marts.top_ranked(marts.pollution_ranking(cda), "pm25", 10)
    plan = _plan(top)
    assert "PartitionFilters: [isnotnull(parameter" in plan and "(parameter#" in plan
    assert "= pm25)" in plan
    assert top.count() == 10


def test_top_k_and_group_limit_operators(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["top10_pm25"](spark, SF0001))
    assert "WindowGroupLimit" in _plan(QUERIES["monthly_top15"](spark, SF0001))


def test_no_python_udf_anywhere(spark):
    for name, q in QUERIES.items():
        if name == "dq_suite":
            continue  # materialises while building; covered by its own test
        plan = _plan(q(spark, SF0001))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_registered_marts_read_one_pollutant_folder(spark):
    for name in ("top10_pm25", "pm25_alerts", "city_trend"):
        plan = _plan(QUERIES[name](spark, SF0001))
        assert "PartitionFilters: [isnotnull(parameter" in plan, name
        assert "= pm25)" in plan, name


def test_window_prunes_months(spark):
    plan = _plan(QUERIES["window_days"](spark, SF0001))
    assert "PartitionFilters: [isnotnull(month" in plan and ">= 2024-01)" in plan


def test_shuffle_join_fallback_gives_same_rows(spark, monkeypatch):
    from cityair.operators import geo
    from cityair.plans import staging as stg_mod
    from cityair.sources import standins as S
    w = world(spark, SF0001)
    fast_stg = staging.stg_air_quality(w.measurements, w.sensors, w.locations, w.weights)
    fast_geo = geo.bbox_match(S.capitals(spark, SF0001), S.stations(spark, SF0001))
    want_stg, want_geo = fast_stg.collect(), fast_geo.collect()
    monkeypatch.setattr(stg_mod, "MAX_BROADCAST_SENSORS", 0)
    monkeypatch.setattr(geo, "MAX_BROADCAST_CAPITAL_CELLS", 0)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        slow_stg = staging.stg_air_quality(w.measurements, w.sensors, w.locations, w.weights)
        slow_geo = geo.bbox_match(S.capitals(spark, SF0001), S.stations(spark, SF0001))
        assert "SortMergeJoin" in _plan(slow_stg) and "SortMergeJoin" in _plan(slow_geo)
        assert sorted(map(tuple, slow_stg.collect())) == sorted(map(tuple, want_stg))
        assert sorted(map(tuple, slow_geo.collect())) == sorted(map(tuple, want_geo))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_aggregations_combine_map_side(spark):
    """Hot keys (a city or a sensor-day holding a third of the rows) are
    reduced in each map task before any shuffle."""
    checks = {"city_daily_avg": ("partial_avg", "partial_max", "partial_count"),
              "kpi_summary": ("partial_count", "partial_sum"),
              "capital_survey": ("partial_count", "partial_min", "partial_max", "partial_sum"),
              "dq_unique": ("partial_count",),
              "merge_upsert": ("partial_min",),
              "tagged_stations": ("partial_min",)}
    for name, parts in checks.items():
        plan = _plan(QUERIES[name](spark, SF0001))
        for p in parts:
            assert p in plan, (name, p)


def test_bucketed_fact_and_dimension_join_without_exchange(spark, scratch):
    """Past the broadcast bound, bucketed landing removes the fact shuffle."""
    from cityair.sources import sinks
    w = world(spark, SF0001)
    dim = staging.sensor_cities(w.sensors, w.locations)
    fact = sinks.save_bucketed_table(w.measurements.drop("month"), "bkt_fact", 8, "sensor_id",
                                     path=scratch + "/bkt_fact")
    dimt = sinks.save_bucketed_table(dim, "bkt_dim", 8, "sensor_id", path=scratch + "/bkt_dim")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        joined = fact.join(dimt, "sensor_id")
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == fact.join(dim, "sensor_id").count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS bkt_fact")
        spark.sql("DROP TABLE IF EXISTS bkt_dim")


def test_flow_joins_a_bucketed_fact_where_it_lies(spark, scratch):
    """From the landed files to staging and the city-day table without an
    exchange of the fact; two loads equal the plain flow."""
    from cityair import flow
    from cityair.plans import incremental, staging
    from cityair.sources import colocated, seeds, standins as S
    ts = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    land = scratch + "/land"
    S.country_payloads(spark, SF0001).write.json(land + "/countries")
    S.location_payloads(spark, SF0001, False).write.json(land + "/locations")
    env = S.day_envelopes(spark, SF0001)
    cut = F.lit(S.SPLIT_TS).cast("timestamp")
    env.where(F.col("ingested_at") < cut).write.options(**ts).json(land + "/a")
    env.where(F.col("ingested_at") >= cut).write.options(**ts).json(land + "/b")
    for days in ("/a", "/b"):
        args = (spark, land + "/countries", land + "/locations", land + days)
        flow.ingest(*args, scratch + "/raw", S.RUN_TS, S.AS_OF, buckets=4)
        plain = flow.ingest(*args, scratch + "/plain", S.RUN_TS, S.AS_OF)
    flow.declare_colocated(spark, scratch + "/raw", 4)  # as a session that only builds
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        stg = colocated.staged(spark, flow.BUCKETED_FACT, flow.BUCKETED_PLACES,
                               seeds.molecular_weights(spark))
        plan = stg._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert "Exchange hashpartitioning" not in plan
        flow.build_colocated(spark, scratch + "/city_daily")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    weights = seeds.molecular_weights(spark)
    want = staging.stg_air_quality(plain["measurements"], plain["sensors"], plain["locations"],
                                   weights)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(stg) == rows(want) and stg.count() > 0
    flow.build_incremental(spark, plain, scratch + "/plain_daily")
    daily = [incremental.read(spark, scratch + p).withColumn("avg_value", F.round("avg_value", 9))
             for p in ("/city_daily", "/plain_daily")]
    assert rows(daily[0]) == rows(daily[1])
    log = flow.load_log(spark, scratch + "/raw").where("table_name = 'measurements'")
    assert log.agg(F.max("rows")).first()[0] == plain["measurements"].count()
