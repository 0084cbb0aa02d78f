"""Refresh of the city-day table from what a load touched.

A load touches readings (a batch of the upsert) or stations (a sensor whose
city changed). Either names city-days; only those are computed again, from
the fact's months that hold them, and only the table's months that hold them
are written. A reading's city and day follow from its key and its station,
never from its value, so the days of a batch also cover the rows it replaced:
a changed pollutant or a value that became unusable is a day computed again
without it.

The table is partitioned by ``month`` and ``parameter``: readers of one
pollutant still read its folders only. A refresh is not one commit (a reader
can see some months renewed before others); repeating it converges to the
same table, so a retried batch is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cityair import schemas
from cityair.operators.joins import broadcast_if_bounded
from cityair.operators.merge import month_of
from cityair.plans import marts, staging
from cityair.sources import sinks

PARTITIONS = ("month", "parameter")
TABLE = schemas.with_fields(schemas.CITY_DAILY_AVG, ("month", StringType()))
KEYS = ("city", "country", "reading_date")
# Touched city-days (of one load) that are broadcast; more are shuffle-joined.
MAX_BROADCAST_DAYS = 1_000_000


def with_month(cda: DataFrame) -> DataFrame:
    return cda.withColumn("month", month_of("reading_date"))


def build(measurements: DataFrame, sensors: DataFrame, locations: DataFrame,
          weights: DataFrame, table_path: str) -> None:
    """The whole table, in the layout that refreshes keep."""
    stg = staging.stg_air_quality(measurements, sensors, locations, weights)
    sinks.write_table(with_month(marts.city_daily_avg(stg)), table_path, PARTITIONS)


def read(spark: SparkSession, table_path: str) -> DataFrame:
    return sinks.read_table(spark, table_path, TABLE)


def touched_by_readings(batch: DataFrame, sensors: DataFrame, locations: DataFrame) -> DataFrame:
    """City-days of a batch of readings, new or changed."""
    dim = broadcast_if_bounded(staging.sensor_cities(sensors, locations),
                               staging.MAX_BROADCAST_SENSORS)
    return _days(batch.select("sensor_id", "date_utc").join(dim, "sensor_id"))


def touched_by_stations(measurements: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """City-days of all readings of sensors whose city or country differs
    between two states of the dimension (``staging.sensor_cities``), under
    the old and under the new one. Sensors that came or went count too."""
    a = before.select("sensor_id", F.struct("city", "country").alias("old"))
    b = after.select("sensor_id", F.struct("city", "country").alias("new"))
    both = a.join(b, "sensor_id", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    places = both.select("sensor_id", F.explode(F.array("old", "new")).alias("p")).where(
        "p IS NOT NULL").select("sensor_id", "p.city", "p.country")
    moved = broadcast_if_bounded(places, staging.MAX_BROADCAST_SENSORS)
    return _days(measurements.select("sensor_id", "date_utc").join(moved, "sensor_id"))


def _days(readings: DataFrame) -> DataFrame:
    return readings.where("city IS NOT NULL AND date_utc IS NOT NULL").select(
        "city", "country", F.to_date("date_utc").alias("reading_date")).distinct()


def _among(rows: DataFrame, days: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on the city-day; NULL countries are equal."""
    same = [rows[k].eqNullSafe(days[k]) for k in KEYS]
    return rows.join(days, same[0] & same[1] & same[2], how)


def refreshed(days: DataFrame, months: list[str], span: tuple, measurements: DataFrame,
              sensors: DataFrame, locations: DataFrame, weights: DataFrame,
              table: DataFrame | None) -> DataFrame:
    """The table's touched months after the refresh, as a plan: their untouched
    city-days as they are, the touched ones computed from the fact's months."""
    days = broadcast_if_bounded(days, MAX_BROADCAST_DAYS)
    first, last = (F.lit(d).cast("date") for d in span)
    fact = measurements.where(F.col("month").isin(months)
                              & (F.col("date_utc") >= first.cast("timestamp"))
                              & (F.col("date_utc") < F.date_add(last, 1).cast("timestamp")))
    stg = staging.stg_air_quality(fact, sensors, locations, weights)
    hit = _among(stg.withColumn("reading_date", F.to_date("date_utc")), days, "left_semi")
    fresh = with_month(marts.city_daily_avg(hit)).select(*TABLE.fieldNames())
    if table is None:
        return fresh
    kept = _among(table.where(F.col("month").isin(months)), days, "left_anti")
    return kept.select(*TABLE.fieldNames()).unionByName(fresh)


def refresh(days: DataFrame, measurements: DataFrame, sensors: DataFrame, locations: DataFrame,
            weights: DataFrame, table_path: str) -> list[str]:
    """Bring the touched city-days of the table up to date; returns its touched
    months. ``measurements`` is the month-partitioned fact after the load."""
    spark = measurements.sparkSession
    days = sinks.materialize(days, "touched_days")  # read by both joins below
    known = days.agg(F.collect_set(month_of("reading_date")).alias("months"),
                     F.min("reading_date").alias("a"), F.max("reading_date").alias("b")).first()
    months = sorted(known["months"])  # a value a month between two dates
    if not months:
        return []
    table = sinks.existing(spark, table_path, TABLE)
    plan = refreshed(days, months, (known["a"], known["b"]), measurements, sensors, locations,
                     weights, table)
    sinks.replace_partitions(plan, table_path, PARTITIONS, table,
                             F.col("month").isin(months))
    return months
