"""Datasets behind the dashboard, computed inside the plan.

Filters, joins, quantiles, per-month top-N and rounding all run in Spark;
only the small final result would ever leave it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityair.functions import constants as K
from cityair.functions.expressions import marker_size, month_key, round_half_even_1
from cityair.operators.joins import broadcast_if_bounded
from cityair.operators.selection import GATHER_ROWS, exact_quantiles


def city_coords(locations: DataFrame) -> DataFrame:
    """Centroid of all stations carrying a capital name."""
    return (locations.groupBy(F.col("capital_name").alias("city"))
                     .agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon")))


def map_alltime(ranking: DataFrame, coords: DataFrame, parameter: str = "pm25") -> DataFrame:
    """All-time average per capital for one pollutant, with coordinates."""
    r = (ranking.where(F.col("parameter") == parameter)
                .select("city", "country", "parameter",
                        F.col("overall_avg_value").alias("avg_value")))
    return r.join(coords, "city", "inner")


def monthly_city_avg(daily: DataFrame, coords: DataFrame | None = None,
                     parameter: str | None = "pm25") -> DataFrame:
    """Mean of daily means per (city, country, month) -> ``ym`` text.

    ``parameter=None`` keeps every pollutant (one series each)."""
    d = daily if parameter is None else daily.where(F.col("parameter") == parameter)
    m = (d.groupBy("parameter", "city", "country", month_key("reading_date").alias("ym"))
          .agg(F.avg("avg_value").alias("avg_value")))
    return m if coords is None else m.join(coords, "city", "inner")


def monthly_top(monthly: DataFrame, n: int = K.TOP_N_BARS) -> DataFrame:
    """Top ``n`` cities of each month by value, ascending for bar drawing.

    ``row_number() <= n`` is planned as a WindowGroupLimit, which keeps at
    most n rows per month in every map partition before the shuffle."""
    w = Window.partitionBy("parameter", "ym").orderBy(
        F.desc("avg_value"), F.asc("city"), F.asc("country"))
    return (monthly.withColumn("month_rank", F.row_number().over(w))
                   .where(F.col("month_rank") <= n)
                   .select("parameter", "ym", "month_rank", "city", "country", "avg_value",
                           round_half_even_1("avg_value").alias("label_value"))
                   .orderBy("parameter", "ym", F.desc("month_rank")))


def alltime_top(alltime: DataFrame, n: int = K.TOP_N_BARS) -> DataFrame:
    """Most polluted capitals of all time (top ``n``)."""
    return (alltime.orderBy(F.desc("avg_value"), "city", "country").limit(n)
                   .select("city", "country", "avg_value"))


def distinct_values(cda: DataFrame, monthly: DataFrame | None = None) -> DataFrame:
    """Sorted distinct lists feeding the selectors, in long form.

    The three city-day columns are stacked into ``(list_name, value)`` pairs
    in one pass, so the mart is scanned once and one distinct (combined map
    side) serves every list."""
    stacked = cda.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("list_name"), F.col(n).alias("value"))
        for n in ("city", "parameter", "country")])).alias("p")).select("p.*")
    if monthly is not None:
        stacked = stacked.unionByName(monthly.select(F.lit("ym").alias("list_name"),
                                                     F.col("ym").alias("value")))
    return stacked.distinct().orderBy("list_name", F.asc_nulls_last("value"))


# One row a pollutant is broadcast up to this many of them.
MAX_BROADCAST_PARAMETERS = 10_000
# Up to this many rows a pollutant's quantiles are one aggregate.
MAX_PERCENTILE_ROWS = 1_000_000


def colour_caps(monthly: DataFrame, max_rows: int = MAX_PERCENTILE_ROWS,
                gather: int = GATHER_ROWS) -> DataFrame:
    """Colour cap (0.95 quantile) and axis cap (0.98 quantile x 1.05) per
    pollutant, with linear interpolation (exact, never approximate).

    ``percentile`` holds a pollutant's distinct values in one task, so it is
    used up to a checked number of rows; beyond it the ranks are selected by
    narrowing brackets (``exact_quantiles``), which gives the same numbers."""
    if monthly.limit(max_rows + 1).count() <= max_rows:
        q = F.percentile("avg_value", F.array(F.lit(K.COLOUR_QUANTILE), F.lit(K.AXIS_QUANTILE)))
        found = monthly.groupBy("parameter").agg(q.alias("q"))
    else:
        found = exact_quantiles(monthly, ["parameter"], "avg_value",
                                (K.COLOUR_QUANTILE, K.AXIS_QUANTILE), gather)
    return found.select("parameter", F.col("q")[0].alias("cmax"),
                        (F.col("q")[1] * K.AXIS_HEADROOM).alias("xmax"))


def map_frames(monthly: DataFrame, caps: DataFrame | None = None) -> DataFrame:
    """Every animation frame at once: marker size and label per city-month.

    The caps are one row per pollutant and meet the frames by an equi-join
    on ``parameter``."""
    caps = colour_caps(monthly) if caps is None else caps
    caps = broadcast_if_bounded(caps, MAX_BROADCAST_PARAMETERS)
    return (monthly.join(caps, "parameter", "inner")
                   .select("parameter", "ym", "city", "country", "lat", "lon", "avg_value",
                           marker_size("avg_value", "cmax").alias("marker_size"),
                           round_half_even_1("avg_value").alias("label_value")))


def latest_month(monthly: DataFrame) -> DataFrame:
    """Rows of the latest month (the initial frame), per pollutant."""
    last = monthly.groupBy("parameter").agg(F.max("ym").alias("ym"))
    return monthly.join(broadcast_if_bounded(last, MAX_BROADCAST_PARAMETERS),
                        ["parameter", "ym"], "inner")


def city_trend(spark: SparkSession, cda: DataFrame, city: str, parameter: str) -> DataFrame:
    """Daily series for one city and pollutant; the values are bound
    parameters, never spliced into the SQL text."""
    return spark.sql(
        "SELECT reading_date, avg_value FROM {cda} "
        "WHERE city = :city AND parameter = :parameter "
        "ORDER BY reading_date, country",
        args={"city": city, "parameter": parameter}, cda=cda)


def alert_filter(countries: Iterable[str] | None = None, start=None, end=None) -> F.Column:
    """Optional country list (empty = all) and inclusive date range (used
    only when both ends are given), as one predicate."""
    cond = F.lit(True)
    countries = list(countries or [])
    if countries:
        cond = cond & F.col("country").isin(countries)
    if start is not None and end is not None:
        cond = cond & F.col("reading_date").between(F.lit(start).cast("date"),
                                                    F.lit(end).cast("date"))
    return cond


def alerts_filtered(alerts: DataFrame, countries=None, start=None, end=None) -> DataFrame:
    return alerts.where(alert_filter(countries, start, end))


def alerts_shown(alerts: DataFrame, countries=None, start=None, end=None) -> DataFrame:
    """``shown`` of ``total`` alert rows in one aggregation."""
    cond = alert_filter(countries, start, end)
    return alerts.agg(F.coalesce(F.count_if(cond), F.lit(0)).cast("long").alias("shown"),
                      F.count(F.lit(1)).alias("total"))
