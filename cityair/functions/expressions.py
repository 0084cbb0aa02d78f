"""Column expressions used across the plans.

Everything here returns a ``Column`` built from built-in Spark functions, so
it stays inside whole-stage codegen; nothing is evaluated in Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cityair.functions import constants as K


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ug_m3(value, unit, molecular_weight) -> Column:
    """Convert a gas reading to µg/m³: ppm ``v*MW*1000/24.45``, ppb ``v*MW/24.45``.

    Any other unit passes the value through. ``unit`` must already be lower
    case. A NULL molecular weight (particulates reported in ppm/ppb) gives
    NULL, as in the original model.
    """
    v, u, mw = col_(value), col_(unit), col_(molecular_weight)
    return (F.when(u == "ppm", v * mw * K.PPM_TO_PPB / K.MOLAR_VOLUME)
             .when(u == "ppb", v * mw / K.MOLAR_VOLUME)
             .otherwise(v))


def passes_unit_caps(value, unit, caps=K.UNIT_CAPS) -> Column:
    """``NOT (unit='ppm' AND v>50) AND NOT (unit='ppb' AND v>50000)``.

    Three-valued on purpose: a NULL unit with a value above a cap yields
    NULL, which a ``where`` treats as false (the row is dropped).
    """
    v, u = col_(value), col_(unit)
    cond = F.lit(True)
    for unit_name, cap in caps:
        cond = cond & ~((u == unit_name) & (v > F.lit(float(cap))))
    return cond


def timestamp_text(ts) -> Column:
    """Text of a UTC timestamp with a zone suffix, as SQL engines print a
    zoned timestamp
    (``2024-01-02 00:00:00+00``); the session zone must be UTC."""
    return F.date_format(col_(ts), "yyyy-MM-dd HH:mm:ssx")


def surrogate_key(sensor_id, date_utc) -> Column:
    """``md5(sensor_id || '-' || date_utc)``; NULL in, NULL out (no concat_ws)."""
    return F.md5(F.concat(col_(sensor_id).cast("string"), F.lit("-"),
                          timestamp_text(date_utc)))


def round_half_even_1(x) -> Column:
    """Round to one decimal, ties to even, like pandas ``Series.round(1)``.

    The value is first snapped to 9 decimals, so an exact tie (x.x5) is
    treated as a tie however its last bits came out of the aggregation."""
    return F.rint(F.round(col_(x), 9) * 10) / 10


def month_key(d) -> Column:
    """``YYYY-MM`` text of the month containing ``d``."""
    return F.date_format(F.date_trunc("month", col_(d)), "yyyy-MM")


def marker_size(value, cmax) -> Column:
    """Dot size ``min(v, cmax)/cmax*26 + 4``; NULL when ``cmax`` is 0."""
    v, c = col_(value), col_(cmax)
    return F.try_divide(F.least(v, c), c) * K.MARKER_SPAN + K.MARKER_MIN


def parse_iso_utc(text) -> Column:
    """ISO-8601 text with ``Z`` or an offset -> timestamp (NULL stays NULL)."""
    return F.to_timestamp(col_(text))


def iso_utc_text(ts) -> Column:
    """Timestamp -> ``2024-01-02T00:00:00Z`` text, as the source API writes it."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def bbox(lat, lon, half_width: float = K.BBOX_HALF_WIDTH) -> dict[str, Column]:
    """Box around a point: min_lon, min_lat, max_lon, max_lat."""
    la, lo = col_(lat), col_(lon)
    h = float(half_width)
    return {"min_lon": lo - h, "min_lat": la - h, "max_lon": lo + h, "max_lat": la + h}


def is_active(last_seen, as_of, within_days: int = K.ACTIVE_WITHIN_DAYS) -> Column:
    """Reported within ``within_days`` of ``as_of`` (inclusive); NULL -> false."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(within_days))
    return F.coalesce(col_(last_seen) >= cutoff, F.lit(False))


def parse_code_list(text: str | None) -> list[str]:
    """Comma list of ISO codes -> trimmed, upper-cased, blanks dropped.

    This parses a configuration value (one string), not table data.
    """
    return [c.strip().upper() for c in (text or "").split(",") if c.strip()]


def null_if_blank(c) -> Column:
    return F.nullif(col_(c), F.lit(""))


def count_where(cond: Column) -> Column:
    """Rows where ``cond`` is true; 0 (not NULL) when none."""
    return F.coalesce(F.count_if(cond), F.lit(0)).cast("long")


def in_list(c, values: Iterable[str]) -> Column:
    return col_(c).isin(list(values))
