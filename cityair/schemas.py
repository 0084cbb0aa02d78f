"""Explicit schemas: raw tables, nested source payloads and marts."""

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType,
                               IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


def with_fields(schema: StructType, *fields) -> StructType:
    """A copy of ``schema`` with extra nullable ``(name, type)`` fields
    (``StructType.add`` would change the shared schema in place)."""
    return StructType(list(schema.fields) + [StructField(n, t, True) for n, t in fields])


S, L, D, B, TS, DT, I = (StringType(), LongType(), DoubleType(), BooleanType(),
                         TimestampType(), DateType(), IntegerType())

# ---- raw tables -------------------------------------------------------------
COUNTRIES = _s(("country_name", S), ("alpha_2", S), ("alpha_3", S), ("region", S),
               ("subregion", S), ("population", L), ("area_sq_km", D),
               ("capital_name", S), ("capital_lat", D), ("capital_lon", D),
               ("ingested_at", TS))

LOCATIONS = _s(("location_id", L), ("name", S), ("locality", S), ("country_id", L),
               ("country_code", S), ("country_name", S), ("capital_country", S),
               ("capital_name", S), ("capital_cca2", S), ("latitude", D),
               ("longitude", D), ("timezone", S), ("provider_id", L),
               ("provider_name", S), ("is_mobile", B), ("is_monitor", B),
               ("datetime_first_utc", TS), ("datetime_last_utc", TS),
               ("ingested_at", TS))

SENSORS = _s(("sensor_id", L), ("location_id", L), ("sensor_name", S),
             ("parameter_id", L), ("parameter_name", S), ("parameter_units", S),
             ("parameter_display_name", S), ("ingested_at", TS))

MEASUREMENTS_DAILY = _s(("sensor_id", L), ("date_utc", TS), ("date_local", S),
                        ("datetime_to_utc", TS), ("value_avg", D), ("value_min", D),
                        ("value_max", D), ("value_median", D), ("value_sd", D),
                        ("parameter_id", L), ("parameter_name", S),
                        ("parameter_units", S), ("expected_count", L),
                        ("observed_count", L), ("percent_complete", D),
                        ("period_label", S), ("ingested_at", TS))

MOLECULAR_WEIGHTS = _s(("parameter", S), ("molecular_weight_g_per_mol", D))

CAPITALS = _s(("country", S), ("cca2", S), ("capital", S), ("lat", D), ("lon", D))

# ---- nested payloads (landed JSON, one object per line) ---------------------
COUNTRY_PAYLOAD = _s(
    ("names", _s(("common", S))),
    ("codes", _s(("alpha_2", S), ("alpha_3", S))),
    ("capitals", ArrayType(_s(("name", S),
                              ("coordinates", _s(("lat", D), ("lng", D))),
                              ("attributes", _s(("primary", B)))))),
    ("region", S), ("subregion", S), ("population", L), ("area", D))

_PARAM = _s(("id", L), ("name", S), ("units", S), ("displayName", S))

LOCATION_PAYLOAD = _s(
    ("id", L), ("name", S), ("locality", S),
    ("country", _s(("id", L), ("code", S), ("name", S))),
    ("provider", _s(("id", L), ("name", S))),
    ("coordinates", _s(("latitude", D), ("longitude", D))),
    ("timezone", S), ("isMobile", B), ("isMonitor", B),
    ("datetimeFirst", _s(("utc", S))), ("datetimeLast", _s(("utc", S))),
    ("sensors", ArrayType(_s(("id", L), ("name", S), ("parameter", _PARAM)))))

# A day reading; the sensor id is not part of the object, so landed files carry
# it in an envelope field next to the reading, optionally with the time the
# record was fetched (the load stamp otherwise).
DAY_PAYLOAD = _s(
    ("value", D),
    ("period", _s(("label", S),
                  ("datetimeFrom", _s(("utc", S), ("local", S))),
                  ("datetimeTo", _s(("utc", S))))),
    ("parameter", _s(("id", L), ("name", S), ("units", S))),
    ("coverage", _s(("expectedCount", L), ("observedCount", L),
                    ("percentComplete", D))),
    ("summary", _s(("min", D), ("max", D), ("median", D), ("sd", D))))

DAY_ENVELOPE = _s(("sensor_id", L), ("reading", DAY_PAYLOAD), ("ingested_at", TS))

# One page of a sensor's day search as landed: its readings (none on an empty
# page), or the error that ended the request.
DAY_PAGE = _s(("sensor_id", L), ("page", I), ("results", ArrayType(DAY_PAYLOAD)), ("error", S),
              ("ingested_at", TS))

# One row a landed page: what the load ledger knows of it.
PAGE_LEDGER = _s(("sensor_id", L), ("page", I), ("rows", L), ("state", S), ("error", S),
                 ("ingested_at", TS))

# ---- models -----------------------------------------------------------------
STG_AIR_QUALITY = _s(("measurement_id", S), ("city", S), ("country", S),
                     ("parameter", S), ("value", D), ("max_value", D), ("unit", S),
                     ("date_utc", TS), ("percent_complete", D))

CITY_DAILY_AVG = _s(("city", S), ("country", S), ("parameter", S),
                    ("reading_date", DT), ("avg_value", D), ("max_value", D),
                    ("num_readings", L))

CITY_POLLUTION_RANKING = _s(("city", S), ("country", S), ("parameter", S),
                            ("overall_avg_value", D), ("overall_max_value", D),
                            ("pollution_rank", I))
