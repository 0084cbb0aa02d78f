"""Marts on top of staging: city-day averages, rankings, KPIs, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityair.functions import constants as K
from cityair.operators.selection import GATHER_ROWS, ranked


def city_daily_avg(stg: DataFrame, extra_keys=()) -> DataFrame:
    """City x country x pollutant x day: mean of sensor-day values, max, count.

    All three aggregates are algebraic, so Spark pre-aggregates each map
    partition before the shuffle on the four keys; a dominant city costs one
    row per map task, not its raw volume.
    """
    keys = ["city", "country", "parameter", *extra_keys]
    return (stg.groupBy(*keys, F.to_date("date_utc").alias("reading_date"))
               .agg(F.avg("value").alias("avg_value"),
                    F.max("max_value").alias("max_value"),
                    F.count(F.lit(1)).alias("num_readings")))


# Up to this many city-days (and so cities) the ranking is one window.
MAX_WINDOW_ROWS = 1_000_000


def overall_by_city(cda: DataFrame) -> DataFrame:
    return (cda.groupBy("city", "country", "parameter")
               .agg(F.avg("avg_value").alias("overall_avg_value"),
                    F.max("max_value").alias("overall_max_value")))


def pollution_ranking(cda: DataFrame, max_window_rows: int = MAX_WINDOW_ROWS,
                      range_rows: int = GATHER_ROWS) -> DataFrame:
    """Per city and pollutant: overall mean of daily means (unweighted), max,
    and ``rank()`` within the pollutant, highest first, NULL averages first.

    A window sorts a pollutant's cities in one task. Beyond a checked bound
    of rows the ranks are made in ranges of values instead (``ranked``), so no
    task holds a pollutant, whatever the number of cities."""
    overall = overall_by_city(cda)
    if cda.limit(max_window_rows + 1).count() > max_window_rows:
        if overall.limit(max_window_rows + 1).count() > max_window_rows:
            return ranked(overall, ["parameter"], "overall_avg_value", "pollution_rank",
                          range_rows)
    w = Window.partitionBy("parameter").orderBy(F.desc_nulls_first("overall_avg_value"))
    return overall.withColumn("pollution_rank", F.rank().over(w))


def top_ranked(ranking: DataFrame, parameter: str = "pm25",
               n: int = K.TOP_N_RANKED) -> DataFrame:
    """The first ``n`` cities by rank for one pollutant (rank order kept)."""
    return (ranking.where(F.col("parameter") == parameter)
                   .orderBy("pollution_rank", "city", "country").limit(n)
                   .select("city", "overall_avg_value", "pollution_rank"))


def kpi_summary(cda: DataFrame) -> DataFrame:
    return cda.agg(F.count_distinct("city").alias("cities_monitored"),
                   F.sum("num_readings").cast("long").alias("total_readings"),
                   F.min("reading_date").alias("earliest_date"),
                   F.max("reading_date").alias("latest_date"))


def pm25_alerts(cda: DataFrame, threshold: float = K.WHO_PM25_24H) -> DataFrame:
    """City-days with mean PM2.5 strictly above the threshold, worst first."""
    return (cda.where((F.col("parameter") == "pm25") & (F.col("avg_value") > threshold))
               .select("city", "country", "reading_date",
                       F.col("avg_value").alias("pm25_avg_value"))
               .orderBy(F.desc("pm25_avg_value"), "city", "country", "reading_date"))
