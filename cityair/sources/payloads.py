"""Nested source payloads -> flat raw tables.

The landed JSON (one object per line) is read with an explicit schema; the
flatteners below are pure projections / ``explode`` on that one scan, so
stations and their sensors come from the same read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cityair import schemas
from cityair.functions.expressions import null_if_blank, parse_iso_utc

CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Scan landed JSON lines (a file, a folder or a list of them: the pages
    and per-capital results of one run form one bag of rows)."""
    return spark.read.schema(schema).json(path)


def read_json_with_quarantine(spark: SparkSession, path, schema: StructType, lineage=()
                              ) -> tuple[DataFrame, DataFrame]:
    """PERMISSIVE scan that splits parsed rows from malformed lines.

    Returns ``(good, quarantine)``; ``quarantine`` holds the raw text of every
    line that did not parse (``raw_record``) and its ``source_file``, so one
    bad record never stops the rest of the load. ``lineage`` names partition
    columns of the landed folder (``capital_cca2=GR/``): they come from the
    path, so a line of which nothing parses still carries them, and both
    outputs keep them. The JSON is parsed once
    into a Parquet copy in the checkpoint folder and both outputs read that
    copy (Spark also refuses queries on raw JSON that read only the
    corrupt-record column).
    """
    from cityair.sources.sinks import materialize

    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    parsed = materialize(
        spark.read.schema(full).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT).json(path)
             .withColumn("source_file", F.input_file_name()), "payload_parsed")
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "source_file")
    bad = (parsed.where(F.col(CORRUPT).isNotNull())
                 .select(F.col(CORRUPT).alias("raw_record"), "source_file", *lineage))
    return good, bad


def _stamp(df: DataFrame, run_ts) -> F.Column:
    """The record's own fetch time when it carries one, else the run's stamp."""
    run = F.lit(run_ts).cast("timestamp")
    if "ingested_at" in df.columns:
        return F.coalesce(F.col("ingested_at").cast("timestamp"), run)
    return run


def primary_capital(capitals) -> F.Column:
    """First capital flagged primary, else the first one, else NULL."""
    caps = F.col(capitals) if isinstance(capitals, str) else capitals
    flagged = F.filter(caps, lambda c: c["attributes"]["primary"])
    return F.coalesce(F.get(flagged, 0), F.get(caps, 0))


def flatten_countries(payload: DataFrame, run_ts=None) -> DataFrame:
    """Country objects -> ``raw.countries`` rows; rows without alpha_2 dropped."""
    cap = primary_capital("capitals")
    out = payload.select(
        F.col("names.common").alias("country_name"),
        null_if_blank("codes.alpha_2").alias("alpha_2"),
        null_if_blank("codes.alpha_3").alias("alpha_3"),
        "region", "subregion", "population",
        F.col("area").alias("area_sq_km"),
        cap["name"].alias("capital_name"),
        cap["coordinates"]["lat"].alias("capital_lat"),
        cap["coordinates"]["lng"].alias("capital_lon"),
        _stamp(payload, run_ts).alias("ingested_at"),
    )
    return out.where(F.col("alpha_2").isNotNull())


def _tag(df: DataFrame, name: str) -> F.Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def flatten_locations(payload: DataFrame, run_ts=None,
                      with_sensor_count: bool = False) -> DataFrame:
    """Station objects -> ``raw.locations`` rows.

    Optional ``capital_country / capital_name / capital_cca2`` columns next to
    the object carry the capital the station was found for; missing nested
    objects read as NULL.
    """
    cols = [
        F.col("id").alias("location_id"), "name", "locality",
        F.col("country.id").alias("country_id"),
        F.col("country.code").alias("country_code"),
        F.col("country.name").alias("country_name"),
        _tag(payload, "capital_country").alias("capital_country"),
        _tag(payload, "capital_name").alias("capital_name"),
        _tag(payload, "capital_cca2").alias("capital_cca2"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        "timezone",
        F.col("provider.id").alias("provider_id"),
        F.col("provider.name").alias("provider_name"),
        F.col("isMobile").alias("is_mobile"),
        F.col("isMonitor").alias("is_monitor"),
        parse_iso_utc("datetimeFirst.utc").alias("datetime_first_utc"),
        parse_iso_utc("datetimeLast.utc").alias("datetime_last_utc"),
        _stamp(payload, run_ts).alias("ingested_at"),
    ]
    if with_sensor_count:
        cols.append(F.coalesce(F.size("sensors"), F.lit(0)).alias("sensor_count"))
    return payload.select(*cols)


def explode_sensors(payload: DataFrame, run_ts=None) -> DataFrame:
    """Sensor rows out of the station objects (NULL / empty arrays yield none)."""
    s = F.col("s")
    return (payload.select(F.col("id").alias("location_id"),
                           _stamp(payload, run_ts).alias("ingested_at"),
                           F.explode("sensors").alias("s"))
            .select(s["id"].alias("sensor_id"), "location_id",
                    s["name"].alias("sensor_name"),
                    s["parameter"]["id"].alias("parameter_id"),
                    s["parameter"]["name"].alias("parameter_name"),
                    s["parameter"]["units"].alias("parameter_units"),
                    s["parameter"]["displayName"].alias("parameter_display_name"),
                    "ingested_at"))


def flatten_measurements(envelopes: DataFrame, run_ts=None) -> DataFrame:
    """Day readings (``sensor_id`` + ``reading`` struct) -> fact rows."""
    r = F.col("reading")
    return envelopes.select(
        F.col("sensor_id").cast("long").alias("sensor_id"),
        parse_iso_utc(r["period"]["datetimeFrom"]["utc"]).alias("date_utc"),
        r["period"]["datetimeFrom"]["local"].alias("date_local"),
        parse_iso_utc(r["period"]["datetimeTo"]["utc"]).alias("datetime_to_utc"),
        r["value"].alias("value_avg"),
        r["summary"]["min"].alias("value_min"),
        r["summary"]["max"].alias("value_max"),
        r["summary"]["median"].alias("value_median"),
        r["summary"]["sd"].alias("value_sd"),
        r["parameter"]["id"].alias("parameter_id"),
        r["parameter"]["name"].alias("parameter_name"),
        r["parameter"]["units"].alias("parameter_units"),
        r["coverage"]["expectedCount"].alias("expected_count"),
        r["coverage"]["observedCount"].alias("observed_count"),
        r["coverage"]["percentComplete"].alias("percent_complete"),
        r["period"]["label"].alias("period_label"),
        _stamp(envelopes, run_ts).alias("ingested_at"),
    )


def read_countries(spark, path, run_ts=None) -> DataFrame:
    return flatten_countries(read_json(spark, path, schemas.COUNTRY_PAYLOAD), run_ts)


def read_locations(spark, path, run_ts=None) -> DataFrame:
    return flatten_locations(read_json(spark, path, schemas.LOCATION_PAYLOAD), run_ts)


def ingest_stations(spark: SparkSession, path, run_ts=None, tags=None,
                    quarantine_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stations and their sensors from ONE parse of the landed JSON.

    The typed payload is written once as Parquet in the checkpoint folder;
    both flatteners then read that copy with column pruning (the sensor
    table reads only ``id`` and ``sensors``), instead of parsing the JSON
    text twice. ``tags`` optionally names capital tag columns present in the
    files (``capital_country``, ``capital_name``, ``capital_cca2``). With
    ``quarantine_path`` malformed lines are appended there and skipped.
    """
    from cityair.sources.sinks import materialize

    schema = schemas.with_fields(schemas.LOCATION_PAYLOAD,
                                 *[(t, StringType()) for t in tags or ()])
    if quarantine_path is None:
        landed = materialize(read_json(spark, path, schema), "location_payload")
    else:
        landed = read_payload(spark, path, schema, quarantine_path)
    return flatten_locations(landed, run_ts), explode_sensors(landed, run_ts)


def read_station_pages(spark: SparkSession, path,
                       quarantine_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Station search results as landed a capital: ``<path>/capital_cca2=GR/*``.

    A line is a station object, or ``{"error": "..."}`` where the request for
    the capital failed. Returns ``(pages, quarantine)``, both with the
    ``capital_cca2`` they were fetched for; with ``quarantine_path`` the
    malformed lines are appended there too.
    """
    schema = schemas.with_fields(schemas.LOCATION_PAYLOAD, ("error", StringType()),
                                 ("capital_cca2", StringType()))
    pages, bad = read_json_with_quarantine(spark, path, schema, ("capital_cca2",))
    if quarantine_path is not None:
        bad.write.mode("append").parquet(quarantine_path)
    return pages, bad


def read_payload(spark: SparkSession, path, schema: StructType,
                 quarantine_path: str | None = None) -> DataFrame:
    """Read landed JSON; with ``quarantine_path``, malformed lines are
    appended to that table (raw text and source file) and left out, so one
    bad record never stops the load."""
    if quarantine_path is None:
        return read_json(spark, path, schema)
    good, bad = read_json_with_quarantine(spark, path, schema)
    bad.write.mode("append").parquet(quarantine_path)
    return good
