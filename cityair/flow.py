"""End to end: landed payload files -> raw tables -> models.

``ingest`` is the loading step (countries, active stations tagged with their
capital, their sensors, daily readings, each upserted by key into its raw
table); ``build`` is the transformation step (staging, the city-day table
partitioned by pollutant, the view marts). Both are plain compositions of the
library's operators; every step is a Spark job over the whole input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

from cityair import schemas
from cityair.operators import geo, ledger, merge
from cityair.plans import incremental, marts
from cityair.plans.models import Models, build_models
from cityair.sources import colocated, loads, namespaces, payloads, seeds, sinks

BUCKETED_FACT = "raw.measurements_bucketed"
BUCKETED_PLACES = "raw.sensor_places"
# Columns of the fact whose NULLs a load counts.
FACT_WATCHED = ("sensor_id", "date_utc", "value_avg", "percent_complete")


@dataclass
class RawPaths:
    """The raw namespace is a folder: ``<base>/<table>``."""
    base: str

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"




def ingest(spark: SparkSession, countries_path, locations_path, days_path, raw_base: str,
           run_ts, as_of, capital_codes=None, capital_limit: int = 0,
           same_country: bool = False, window_days: int | None = None,
           max_per_capital: int | None = None, buckets: int | None = None
           ) -> dict[str, DataFrame]:
    """Load one run of landed files into the raw tables under ``raw_base``.

    Dimension tables are versioned snapshots (small); the fact table is
    partitioned by month and only the months a run touches are rewritten.
    Malformed lines of any payload are appended to ``raw_base/_quarantine``
    and the rest of the run goes on. What the write jobs counted is logged
    (``load_log``), so a load is verified without reading it again. Returns
    the current raw tables.

    With ``buckets`` the fact, and the sensors' cities beside it, are bucketed
    by sensor and named in the catalog (``sources.colocated``): for sensors
    beyond the broadcast bound. Keep the number over all runs of a table.
    """
    raw = RawPaths(raw_base)
    quarantine = raw.path("_quarantine")
    countries = payloads.flatten_countries(payloads.read_payload(
        spark, countries_path, schemas.COUNTRY_PAYLOAD, f"{quarantine}/countries"), run_ts)
    capitals = geo.filter_capitals(geo.capitals_dim(countries), capital_codes, capital_limit)
    stations, sensors = payloads.ingest_stations(
        spark, locations_path, run_ts, quarantine_path=f"{quarantine}/locations")
    tagged = geo.tag_stations(capitals, stations, as_of, same_country=same_country,
                              max_per_capital=max_per_capital)
    tagged_sensors = sensors.join(tagged.select("location_id"), "location_id", "left_semi")
    days = payloads.flatten_measurements(payloads.read_payload(
        spark, days_path, schemas.DAY_ENVELOPE, f"{quarantine}/days"), run_ts)
    if window_days is not None:
        days = merge.within_window(days, "date_utc", as_of, window_days)

    watch = loads.Watch()
    for name, df, keys in (("countries", countries, ["alpha_2"]),
                           ("locations", tagged.select(*schemas.LOCATIONS.fieldNames()),
                            ["location_id"]),
                           ("sensors", tagged_sensors, ["sensor_id"])):
        _upsert_snapshot(df, raw.path(name), keys, watch(name, keys))
    through = watch("measurements", FACT_WATCHED)
    if buckets:
        declare_colocated(spark, raw_base, buckets)
        colocated.upsert_fact(days, BUCKETED_FACT, buckets, through)
        dims = read_dimensions(spark, raw_base)
        colocated.replace_places(dims["sensors"], dims["locations"], BUCKETED_PLACES, buckets)
    else:
        sinks.upsert_partitions(days, raw.path("measurements"), ["sensor_id", "date_utc"],
                                "month", merge.month_of("date_utc"), through=through)
    loads.log(spark, raw.path("_loads"), run_ts, watch.figures)
    return read_raw(spark, raw_base)


def load_log(spark: SparkSession, raw_base: str) -> DataFrame:
    """What each load's write jobs counted: (table_name, run_ts, rows, nulls).
    Rows of the fact are those of the months that the load touched."""
    return loads.read_log(spark, RawPaths(raw_base).path("_loads"))


def _upsert_snapshot(df: DataFrame, base: str, keys, through) -> None:
    spark = df.sparkSession
    current = sinks.current_version(spark, base)
    existing = None if current is None else sinks.read_snapshot(spark, base, df.schema, current)
    merged = merge.merge_upsert(existing, df, keys)
    sinks.write_snapshot(merged, base, 0 if current is None else current + 1, through)


def declare_colocated(spark: SparkSession, raw_base: str, buckets: int) -> None:
    """Name the bucketed fact and places under ``raw_base`` in the catalog (also
    for a session that only builds)."""
    raw = RawPaths(raw_base)
    namespaces.create(spark, raw.path("_schemas"))
    colocated.declare(spark, BUCKETED_FACT, colocated.FACT, raw.path("measurements"), buckets,
                      ("month",))
    colocated.declare(spark, BUCKETED_PLACES, colocated.PLACES, raw.path("sensor_places"), buckets)


def build_colocated(spark: SparkSession, table_path: str) -> None:
    """The city-day table from the bucketed tables: the fact is joined where it
    lies; only its city-day sums are exchanged."""
    stg = colocated.staged(spark, BUCKETED_FACT, BUCKETED_PLACES, seeds.molecular_weights(spark))
    sinks.write_table(incremental.with_month(marts.city_daily_avg(stg)), table_path,
                      incremental.PARTITIONS)


def read_dimensions(spark: SparkSession, raw_base: str) -> dict[str, DataFrame]:
    raw = RawPaths(raw_base)
    return {name: sinks.read_snapshot(spark, raw.path(name), schema)
            for name, schema in (("countries", schemas.COUNTRIES),
                                 ("locations", schemas.LOCATIONS),
                                 ("sensors", schemas.SENSORS))}


def read_raw(spark: SparkSession, raw_base: str) -> dict[str, DataFrame]:
    raw = RawPaths(raw_base)
    out = read_dimensions(spark, raw_base)
    fact_schema = schemas.with_fields(schemas.MEASUREMENTS_DAILY, ("month", StringType()))
    out["measurements"] = spark.read.schema(fact_schema).parquet(raw.path("measurements"))
    return out


def build(spark: SparkSession, raw: dict[str, DataFrame], table_path: str | None = None
          ) -> Models:
    """The transformation step over the raw tables."""
    return build_models(raw["measurements"], raw["sensors"], raw["locations"],
                        seeds.molecular_weights(spark), table_path)


def build_incremental(spark: SparkSession, raw: dict[str, DataFrame], table_path: str) -> None:
    """Write the whole city-day table in the layout that ``refresh`` keeps."""
    incremental.build(raw["measurements"], raw["sensors"], raw["locations"],
                      seeds.molecular_weights(spark), table_path)


def refresh(spark: SparkSession, batch: DataFrame, raw_base: str, table_path: str) -> list[str]:
    """Bring the city-day table up to date after ``batch`` (readings) was
    upserted into the raw fact: only the city-days it touches are computed,
    only their months read and written. Returns those months."""
    raw = read_raw(spark, raw_base)
    days = incremental.touched_by_readings(batch, raw["sensors"], raw["locations"])
    return incremental.refresh(days, raw["measurements"], raw["sensors"], raw["locations"],
                               seeds.molecular_weights(spark), table_path)


def stream_days(spark: SparkSession, days_dir: str, raw_base: str, checkpoint_location: str,
                run_ts=None, max_files_per_trigger: int | None = None,
                options: dict | None = None, table_path: str | None = None) -> None:
    """Incremental form of the fact load: new day files under ``days_dir``
    are upserted into the month-partitioned ``raw.measurements`` (only the
    months they touch are rewritten); the query checkpoint remembers which
    files were loaded, so a re-run after a stop continues where it stopped.
    With ``table_path`` each batch then refreshes the city-day table there.
    """
    from cityair.streaming.incremental import upsert_stream

    upsert_stream(spark, days_dir, schemas.DAY_ENVELOPE, RawPaths(raw_base).path("measurements"),
                  checkpoint_location, ["sensor_id", "date_utc"],
                  transform=lambda df: payloads.flatten_measurements(df, run_ts),
                  max_files_per_trigger=max_files_per_trigger, options=options,
                  partition_by=("month", merge.month_of("date_utc")),
                  on_batch=table_path and (lambda batch: refresh(
                      batch.sparkSession, batch, raw_base, table_path)))


def stream_day_pages(spark: SparkSession, pages_dir: str, raw_base: str,
                     checkpoint_location: str, page_rows: int, run_ts=None,
                     max_files_per_trigger: int | None = None) -> None:
    """The paged form of the fact load: readings into ``raw.measurements``, the
    pages into the ledger beside it (``raw_base/_ledger``)."""
    from cityair.streaming.incremental import stream_pages

    raw = RawPaths(raw_base)
    stream_pages(spark, pages_dir, raw.path("measurements"), raw.path("_ledger"),
                 checkpoint_location, page_rows, run_ts, max_files_per_trigger)


def pending_sensors(spark: SparkSession, candidates: DataFrame, raw_base: str) -> DataFrame:
    """Sensors still to be loaded, by the ledger alone (the fact isn't read)."""
    return ledger.pending(candidates, ledger.read(spark, RawPaths(raw_base).path("_ledger")))


def publish(spark: SparkSession, raw_base: str, table_path: str, schema_base: str) -> list[str]:
    """Make the raw tables and the five models readable by name from every
    session: schemas ``raw`` and ``analytics``. ``table_path`` is a city-day
    table as ``build_incremental`` writes it."""
    namespaces.create(spark, schema_base)
    namespaces.publish_raw(spark, raw_base)
    return namespaces.publish_models(spark, table_path)
