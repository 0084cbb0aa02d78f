"""Documented refinements of the city-day mart (off the default path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cityair.functions import constants as K

DAY_KEYS = ("city", "country", "parameter", "reading_date")


def city_daily_confidence(stg_with_station: DataFrame, low_at_most: int = 2) -> DataFrame:
    """City-day mart plus ``station_count`` and a ``low`` confidence flag.

    Two-level aggregation instead of ``count(distinct)`` next to ``avg``:
    per station first (sum, count, max), then per city-day; the station
    count is the number of first-level rows. Both levels pre-aggregate map
    side, and no Expand doubles the input.
    """
    per_station = (stg_with_station
                   .groupBy("city", "country", "parameter",
                            F.to_date("date_utc").alias("reading_date"), "location_id")
                   .agg(F.sum("value").alias("s"), F.count("value").alias("c"),
                        F.max("max_value").alias("m"), F.count(F.lit(1)).alias("n")))
    out = (per_station.groupBy(*DAY_KEYS)
           .agg(F.try_divide(F.sum("s"), F.sum("c")).alias("avg_value"),
                F.max("m").alias("max_value"),
                F.sum("n").cast("long").alias("num_readings"),
                F.count(F.lit(1)).alias("station_count")))
    return out.withColumn("confidence", F.when(F.col("station_count") <= low_at_most, "low")
                          .otherwise("normal"))


def city_daily_region(cda_with_code: DataFrame, countries: DataFrame) -> DataFrame:
    """Attach region / subregion by the capital's ISO code (never by name)."""
    dim = countries.select(F.col("alpha_2").alias("capital_cca2"), "region", "subregion")
    return cda_with_code.join(dim, "capital_cca2", "left")


LIMIT_SCHEMA = StructType([StructField("parameter", StringType(), True),
                           StructField("limit_24h", DoubleType(), True),
                           StructField("limit_annual", DoubleType(), True)])


def who_flags(spark: SparkSession, cda: DataFrame, limits: dict) -> DataFrame:
    """``exceeds_who_24h`` per city-day and ``exceeds_who_annual`` on the
    calendar-year mean of daily means. Limits are user input
    ``{parameter: (limit_24h, limit_annual)}``; a missing limit gives NULL.
    O3's guideline is an 8-hour mean, so its rows carry a caveat."""
    lim = spark.createDataFrame([(p, *(None if x is None else float(x) for x in v))
                                 for p, v in limits.items()], LIMIT_SCHEMA)
    # A city-pollutant-year holds at most 366 rows, so this window stays small.
    w = Window.partitionBy("city", "country", "parameter", F.year("reading_date"))
    return (cda.join(F.broadcast(lim), "parameter", "left")
               .withColumn("annual_avg_value", F.avg("avg_value").over(w))
               .select(*DAY_KEYS, "avg_value",
                       (F.col("avg_value") > F.col("limit_24h")).alias("exceeds_who_24h"),
                       (F.col("annual_avg_value") > F.col("limit_annual")).alias("exceeds_who_annual"),
                       F.when(F.col("parameter") == "o3",
                              F.lit("guideline is an 8-hour mean; daily mean not comparable"))
                        .alias("caveat")))


def default_limits() -> dict:
    """Only the PM2.5 24-hour figure is fixed by the pipeline; the rest is
    for the user to supply."""
    return {"pm25": (K.WHO_PM25_24H, None)}
