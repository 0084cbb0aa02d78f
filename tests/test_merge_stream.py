"""Upsert by key, batch and streaming, and resume."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cityair import schemas
from cityair.operators import merge
from cityair.sources import payloads, sinks, standins as S
from cityair.streaming.incremental import upsert_stream
from conftest import SF0001
from helpers import measurement

KEYS = ["sensor_id", "date_utc"]
T1, T2 = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)


def test_upsert_inserts_updates_and_is_idempotent(spark):
    old = spark.createDataFrame([measurement(1, 1.0, ingested_at=T1),
                                 measurement(2, 2.0, ingested_at=T1)], schemas.MEASUREMENTS_DAILY)
    new = spark.createDataFrame([measurement(2, 20.0, ingested_at=T2),
                                 measurement(3, 3.0, ingested_at=T2)], schemas.MEASUREMENTS_DAILY)
    once = merge.merge_upsert(old, new, KEYS)
    assert sorted((r.sensor_id, r.value_avg) for r in once.collect()) == [(1, 1.0), (2, 20.0), (3, 3.0)]
    twice = merge.merge_upsert(once, new, KEYS)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_late_reading_for_old_day_is_an_upsert(spark):
    day0 = dt.datetime(2023, 6, 1)
    old = spark.createDataFrame([measurement(1, 1.0, day=day0, ingested_at=T1)],
                                schemas.MEASUREMENTS_DAILY)
    late = spark.createDataFrame([measurement(1, 9.0, day=day0, ingested_at=T2)],
                                 schemas.MEASUREMENTS_DAILY)
    assert merge.merge_upsert(old, late, KEYS).first().value_avg == 9.0


def test_equal_stamp_increment_wins_and_ties_are_deterministic(spark):
    old = spark.createDataFrame([measurement(1, 1.0, ingested_at=T1)], schemas.MEASUREMENTS_DAILY)
    new = spark.createDataFrame([measurement(1, 5.0, ingested_at=T1)], schemas.MEASUREMENTS_DAILY)
    assert merge.merge_upsert(old, new, KEYS).first().value_avg == 5.0
    dup = spark.createDataFrame([measurement(1, 7.0, ingested_at=T1),
                                 measurement(1, 6.0, ingested_at=T1)], schemas.MEASUREMENTS_DAILY)
    assert merge.merge_upsert(None, dup, KEYS).first().value_avg == 6.0


def test_hot_key_is_combined_map_side(spark):
    """One key holding most rows: the plan pre-aggregates before the shuffle."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("timestamp").alias("ingested_at"), F.col("id").alias("v"))
    out = merge.latest_per_key(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert out.where("k = 0").first().v == 19998


def test_pending_is_anti_join(spark):
    cand = spark.createDataFrame([(1,), (2,), (3,)], "sensor_id long")
    done = spark.createDataFrame([(2,), (2,)], "sensor_id long")
    assert sorted(r.sensor_id for r in merge.pending(cand, done).collect()) == [1, 3]


TS_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _land(spark, folder, df):
    df.write.mode("overwrite").options(**TS_FORMAT).json(folder)


def test_stream_two_increments_equal_one_batch_and_rerun_is_noop(spark, scratch):
    env = S.day_envelopes(spark, SF0001)
    split = F.lit(S.SPLIT_TS).cast("timestamp")
    src, target, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    _land(spark, f"{src}/part1", env.where(F.col("ingested_at") < split))
    schema = env.schema

    def flat(df):
        return payloads.flatten_measurements(df)

    upsert_stream(spark, src + "/*", schema, target, ckpt, KEYS, transform=flat, options=TS_FORMAT)
    v1 = sinks.current_version(spark, target)
    _land(spark, f"{src}/part2", env.where(F.col("ingested_at") >= split))
    upsert_stream(spark, src + "/*", schema, target, ckpt, KEYS, transform=flat, options=TS_FORMAT)
    v2 = sinks.current_version(spark, target)
    assert v2 == v1 + 1
    got = sinks.read_snapshot(spark, target, schemas.MEASUREMENTS_DAILY)
    want = S.measurements_daily(spark, SF0001)
    assert got.count() == 792
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # Nothing new landed: the checkpoint skips every file, no new version.
    upsert_stream(spark, src + "/*", schema, target, ckpt, KEYS, transform=flat, options=TS_FORMAT)
    assert sinks.current_version(spark, target) == v2


def test_snapshot_versions_and_retry(spark, scratch):
    df = spark.createDataFrame([measurement(1, 1.0)], schemas.MEASUREMENTS_DAILY)
    base = os.path.join(scratch, "t")
    assert sinks.current_version(spark, base) is None
    sinks.write_snapshot(df, base, 0)
    sinks.write_snapshot(df, base, 0)  # a retried batch rewrites its own version
    assert sinks.current_version(spark, base) == 0
    assert sinks.read_snapshot(spark, base, schemas.MEASUREMENTS_DAILY).count() == 1


def test_materialize_goes_to_checkpoint_dir(spark):
    df = spark.range(5).withColumn("p", F.col("id") % 2)
    out = sinks.materialize(df, "t", partition_by=("p",))
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4]
    assert spark.conf.get("spark.checkpoint.dir") in out.inputFiles()[0]


def test_partitioned_upsert_rewrites_only_touched_months(spark, scratch):
    month = F.date_format("date_utc", "yyyy-MM")
    table = os.path.join(scratch, "fact")
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    first = spark.createDataFrame([measurement(1, 1.0, day=jan, ingested_at=T1),
                                   measurement(2, 2.0, day=feb, ingested_at=T1)],
                                  schemas.MEASUREMENTS_DAILY)
    assert sorted(sinks.upsert_partitions(first, table, KEYS, "month", month)) == ["2024-01", "2024-02"]
    jan_files = sorted(os.listdir(os.path.join(table, "month=2024-01")))
    late = spark.createDataFrame([measurement(2, 20.0, day=feb, ingested_at=T2),
                                  measurement(3, 3.0, day=feb, ingested_at=T2)],
                                 schemas.MEASUREMENTS_DAILY)
    assert sinks.upsert_partitions(late, table, KEYS, "month", month) == ["2024-02"]
    assert sorted(os.listdir(os.path.join(table, "month=2024-01"))) == jan_files  # untouched
    got = {(r.sensor_id, r.value_avg) for r in spark.read.parquet(table).collect()}
    assert got == {(1, 1.0), (2, 20.0), (3, 3.0)}
    # the same batch again changes nothing
    sinks.upsert_partitions(late, table, KEYS, "month", month)
    assert spark.read.parquet(table).count() == 3


def test_stream_into_partitioned_table(spark, scratch):
    env = S.day_envelopes(spark, SF0001)
    src, target, ckpt = (os.path.join(scratch, x) for x in ("landing", "fact", "ckpt"))
    _land(spark, f"{src}/part1", env)
    upsert_stream(spark, src + "/*", env.schema, target, ckpt, KEYS,
                  transform=payloads.flatten_measurements, options=TS_FORMAT,
                  partition_by=("month", F.date_format("date_utc", "yyyy-MM")))
    got = spark.read.parquet(target).drop("month")
    want = S.measurements_daily(spark, SF0001)
    assert got.count() == 792
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_results_do_not_depend_on_partitioning(spark):
    """Same rows whatever the input split: retried or rebalanced tasks
    recompute exactly the same survivors."""
    r = S.readings(spark, SF0001)
    a = merge.latest_per_key(r.repartition(7, "value_avg"), KEYS)
    b = merge.latest_per_key(r.coalesce(1), KEYS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    from cityair.operators import geo
    caps, st = S.capitals(spark, SF0001), S.stations(spark, SF0001)
    t1 = geo.tag_stations(caps, st.repartition(5), S.AS_OF)
    t2 = geo.tag_stations(caps, st.coalesce(1), S.AS_OF)
    assert t1.exceptAll(t2).count() == 0 and t2.exceptAll(t1).count() == 0


def test_stream_micro_batches_and_resume(spark, scratch):
    """One file per micro-batch: each batch commits its own version; a later
    run picks up only the newly landed file."""
    env = S.day_envelopes(spark, SF0001)
    src, target, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    days = F.dayofmonth("ingested_at")
    for i, (lo, hi) in enumerate(((1, 10), (11, 20))):
        env.where(days.between(lo, hi)).coalesce(1).write.options(**TS_FORMAT).json(f"{src}/p{i}")
    kw = dict(transform=payloads.flatten_measurements, options=TS_FORMAT, max_files_per_trigger=1)
    upsert_stream(spark, src + "/*", env.schema, target, ckpt, KEYS, **kw)
    assert sinks.current_version(spark, target) == 1          # two batches: v0, v1
    env.where(days >= 21).coalesce(1).write.options(**TS_FORMAT).json(f"{src}/p2")
    upsert_stream(spark, src + "/*", env.schema, target, ckpt, KEYS, **kw)
    assert sinks.current_version(spark, target) == 2          # only the new file
    got = sinks.read_snapshot(spark, target, schemas.MEASUREMENTS_DAILY)
    want = S.measurements_daily(spark, SF0001)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
