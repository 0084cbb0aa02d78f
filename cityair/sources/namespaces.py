"""The schemas ``raw`` and ``analytics`` in Spark's catalog.

Every session of the application reads the tables and models by name
(``SELECT ... FROM analytics.city_pollution_ranking``). ``raw`` holds the
loaded tables: the month-partitioned fact as an external table with its
explicit schema, the dimensions as views of their committed snapshot.
``analytics`` holds the city-day table and, as lasting SQL views over names,
staging and the three marts. Views are replaced in place, so a reader sees
the state before or after a load. Spark's in-process catalog is enough; with
a persistent metastore the same names outlive the application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from cityair import schemas
from cityair.functions import constants as K
from cityair.plans.incremental import TABLE as CITY_DAILY
from cityair.sources import sinks

RAW, ANALYTICS = "raw", "analytics"
FACT = schemas.with_fields(schemas.MEASUREMENTS_DAILY, ("month", StringType()))
DIMENSIONS = {"countries": schemas.COUNTRIES, "locations": schemas.LOCATIONS,
              "sensors": schemas.SENSORS}
MODELS = ("stg_air_quality", "city_daily_avg", "city_pollution_ranking", "kpi_summary",
          "who_pm25_alerts")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create(spark: SparkSession, base: str, raw: str = RAW, analytics: str = ANALYTICS) -> None:
    """Create both schemas with their folders under ``base``."""
    for name in (raw, analytics):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} "
                  f"LOCATION {_text(f'{base.rstrip('/')}/{name}')}")


def _external(spark: SparkSession, name: str, schema: StructType, path: str,
              partitions: tuple) -> None:
    """An external Parquet table over ``path``; only its entry in the catalog is
    replaced, never its files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(partitions)}) LOCATION {_text(path)}")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def publish_raw(spark: SparkSession, raw_base: str, raw: str = RAW) -> None:
    """Name the raw tables under ``raw_base`` as they are after a load."""
    base = raw_base.rstrip("/")
    for name, schema in DIMENSIONS.items():
        version = sinks.current_version(spark, f"{base}/{name}")
        if version is None:
            continue
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                            for f in schema.fields)
        spark.sql(f"CREATE OR REPLACE VIEW {raw}.{name} AS "
                  f"SELECT {columns} FROM parquet.`{base}/{name}/v={version}`")
    _external(spark, f"{raw}.measurements_daily", FACT, f"{base}/measurements", ("month",))


def staging_sql(raw: str = RAW) -> str:
    """Staging as SQL over the raw names; the rules of ``plans.staging``."""
    weights = ", ".join(f"({_text(p)}, CAST({'NULL' if w is None else w} AS DOUBLE))"
                        for p, w in K.MOLECULAR_WEIGHTS)
    targets = ", ".join(_text(p) for p in K.TARGET_POLLUTANTS)
    caps = "".join(f"\n  AND NOT (unit = {_text(u)} AND value_avg > {cap}D)" for u, cap in K.UNIT_CAPS)
    convert = (f"CASE unit WHEN 'ppm' THEN {{v}} * w * {K.PPM_TO_PPB} / {K.MOLAR_VOLUME}D "
               f"WHEN 'ppb' THEN {{v}} * w / {K.MOLAR_VOLUME}D ELSE {{v}} END")
    return f"""
WITH joined AS (
  SELECT m.sensor_id, m.date_utc, m.value_avg, m.value_max, m.percent_complete,
         lower(m.parameter_name) AS parameter, lower(m.parameter_units) AS unit,
         l.capital_name AS city, l.country_name AS country, w.w
  FROM {raw}.measurements_daily m
  JOIN {raw}.sensors s ON m.sensor_id = s.sensor_id
  JOIN {raw}.locations l ON s.location_id = l.location_id
  LEFT JOIN (VALUES {weights}) AS w(parameter, w) ON lower(m.parameter_name) = w.parameter
  WHERE m.value_avg >= 0 AND m.value_avg < {K.OVER_RANGE}D
    AND m.percent_complete >= {K.MIN_PERCENT_COMPLETE}D)
SELECT md5(concat(CAST(sensor_id AS STRING), '-',
                  date_format(date_utc, 'yyyy-MM-dd HH:mm:ss'), '+00')) AS measurement_id,
       city, country, parameter, {convert.format(v='value_avg')} AS value,
       {convert.format(v='value_max')} AS max_value, {_text(K.CLEAN_UNIT)} AS unit, date_utc,
       percent_complete
FROM joined
WHERE parameter IN ({targets}) AND city IS NOT NULL{caps}"""


def mart_sql(analytics: str = ANALYTICS) -> dict[str, str]:
    cda = f"{analytics}.city_daily_avg"
    return {
        "city_pollution_ranking": f"""
SELECT *, rank() OVER (PARTITION BY parameter ORDER BY overall_avg_value DESC NULLS FIRST)
         AS pollution_rank
FROM (SELECT city, country, parameter, avg(avg_value) AS overall_avg_value,
             max(max_value) AS overall_max_value
      FROM {cda} GROUP BY city, country, parameter)""",
        "kpi_summary": f"""
SELECT count(DISTINCT city) AS cities_monitored, sum(num_readings) AS total_readings,
       min(reading_date) AS earliest_date, max(reading_date) AS latest_date FROM {cda}""",
        "who_pm25_alerts": f"""
SELECT city, country, reading_date, avg_value AS pm25_avg_value FROM {cda}
WHERE parameter = 'pm25' AND avg_value > {K.WHO_PM25_24H}D
ORDER BY avg_value DESC, city, country, reading_date"""}


def publish_models(spark: SparkSession, table_path: str, raw: str = RAW,
                   analytics: str = ANALYTICS) -> list[str]:
    """Name the models: the city-day table at ``table_path`` (laid out by
    ``plans.incremental``), staging and the marts. Returns their names."""
    _external(spark, f"{analytics}.city_daily_avg", CITY_DAILY, table_path,
              ("month", "parameter"))
    views = {"stg_air_quality": staging_sql(raw), **mart_sql(analytics)}
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {analytics}.{name} AS {text}")
    return [f"{analytics}.{m}" for m in MODELS]


def model(spark: SparkSession, name: str, analytics: str = ANALYTICS) -> DataFrame:
    return spark.table(f"{analytics}.{name}")
