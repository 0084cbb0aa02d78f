"""Staging: one clean row per (sensor, day) in µg/m³.

Plan shape: the fact scan carries every row filter (Catalyst pushes the
range / completeness / NULL predicates into the scan), then one join with
the sensor -> station -> city dimension and a lookup of six molecular
weights. The dimension is broadcast only after a bounded row count; a larger
one is shuffle-joined (the fact moves once, on ``sensor_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.functions import constants as K
from cityair.functions.expressions import passes_unit_caps, surrogate_key, to_ug_m3
from cityair.operators.joins import broadcast_if_bounded

# The sensor -> city dimension is broadcast only while a bounded count shows
# at most this many rows (about 80 MB at the four columns kept); beyond it
# the fact is shuffle-joined once on sensor_id.
MAX_BROADCAST_SENSORS = 1_000_000

STAGING_COLUMNS = ("measurement_id", "city", "country", "parameter", "value",
                   "max_value", "unit", "date_utc", "percent_complete")


def sensor_cities(sensors: DataFrame, locations: DataFrame, extra_location_cols=()) -> DataFrame:
    """sensor_id -> station -> (city, country): the two dimensions joined to
    each other first, so the fact table meets one dimension in one join.

    If that dimension ever outgrows the broadcast threshold, the fact is
    shuffled once on ``sensor_id`` (instead of once per dimension)."""
    s = sensors.select("sensor_id", "location_id")
    loc = locations.select("location_id", F.col("capital_name").alias("city"),
                           F.col("country_name").alias("country"), *extra_location_cols)
    return s.join(loc, "location_id", "inner")


def joined_readings(measurements: DataFrame, sensors: DataFrame, locations: DataFrame,
                    weights: DataFrame, extra_location_cols=(),
                    dim: DataFrame | None = None) -> DataFrame:
    """Non-NULL readings joined to sensor, station and molecular weight. ``dim``
    is the joined dimension where it is a table of its own (co-located with the
    fact by bucket); it is joined as it lies."""
    m = measurements.where(F.col("value_avg").isNotNull()).select(
        "sensor_id", "date_utc", "value_avg", "value_max",
        F.lower("parameter_name").alias("parameter"),
        F.lower("parameter_units").alias("unit"),
        "expected_count", "observed_count", "percent_complete")
    # Without column statistics Spark estimates a join of two tables as the
    # product of their sizes, so the pre-joined dimension would plan as a
    # shuffle join of the whole fact; a bounded count decides instead.
    if dim is None:
        dim = broadcast_if_bounded(sensor_cities(sensors, locations, extra_location_cols),
                                   MAX_BROADCAST_SENSORS)
    # The seed has six rows: a fixed size, so it is always broadcast.
    mw = F.broadcast(weights.select("parameter", "molecular_weight_g_per_mol"))
    return m.join(dim, "sensor_id", "inner").join(mw, "parameter", "left")


def clean_conditions(value: str = "value_avg") -> F.Column:
    v = F.col(value)
    return ((v >= 0) & (v < K.OVER_RANGE)
            & (F.col("percent_complete") >= K.MIN_PERCENT_COMPLETE)
            & F.col("parameter").isin(list(K.TARGET_POLLUTANTS))
            & F.col("city").isNotNull()
            & passes_unit_caps(v, "unit"))


def stg_air_quality(measurements: DataFrame, sensors: DataFrame, locations: DataFrame,
                    weights: DataFrame, over_range: str = "drop",
                    keep=(), dim: DataFrame | None = None) -> DataFrame:
    """The staging model.

    ``over_range='clip'`` keeps readings at or above the over-range ceiling
    with their value clipped to it (the documented alternative to dropping);
    ``'drop'`` (default) removes them. ``keep`` names extra columns of the
    joined rows to carry (e.g. ``location_id`` for station counts).
    """
    extra_loc = [c for c in keep if c not in ("location_id", "sensor_id")]
    j = joined_readings(measurements, sensors, locations, weights, extra_loc, dim)
    if over_range == "clip":
        j = j.withColumn("value_avg", F.least(F.col("value_avg"), F.lit(K.OVER_RANGE)))
        v = F.col("value_avg")
        cond = ((v >= 0) & (F.col("percent_complete") >= K.MIN_PERCENT_COMPLETE)
                & F.col("parameter").isin(list(K.TARGET_POLLUTANTS))
                & F.col("city").isNotNull() & passes_unit_caps(v, "unit"))
    elif over_range == "drop":
        cond = clean_conditions()
    else:
        raise ValueError(over_range)
    mw = F.col("molecular_weight_g_per_mol")
    return j.where(cond).select(
        surrogate_key("sensor_id", "date_utc").alias("measurement_id"),
        "city", "country", "parameter",
        to_ug_m3("value_avg", "unit", mw).alias("value"),
        to_ug_m3("value_max", "unit", mw).alias("max_value"),
        F.lit(K.CLEAN_UNIT).alias("unit"),
        "date_utc", "percent_complete", *keep)


def converted_readings(measurements, sensors, locations, weights) -> DataFrame:
    """Every joined reading with its µg/m³ value, before any cleaning rule."""
    j = joined_readings(measurements, sensors, locations, weights)
    mw = F.col("molecular_weight_g_per_mol")
    return j.select("sensor_id", "date_utc", "parameter", "unit", "value_avg",
                    to_ug_m3("value_avg", "unit", mw).alias("value"),
                    to_ug_m3("value_max", "unit", mw).alias("max_value"))
