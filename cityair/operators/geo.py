"""Capitals and the station-to-capital box match (a 2-D range join).

The box join is written as a grid equi-join: every capital is copied into
the grid cells its box touches (at most four when the cell edge equals the
box width), every station falls into exactly one cell, the two meet on the
cell key and the exact inclusive box test runs on the few pairs that share
a cell. A pair meets in exactly one cell, so no de-duplication is needed, and
no nested-loop join over all capital x station pairs is ever planned.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityair.functions import constants as K
from cityair.functions.expressions import is_active, parse_code_list
from cityair.operators.joins import broadcast_if_bounded
from cityair.operators.merge import pick_per_key, newest_first

# Capitals are one per country; the box side is broadcast only while it
# stays under this many rows (cells x capitals), otherwise shuffle-joined.
MAX_BROADCAST_CAPITAL_CELLS = 200_000

TAG_COLUMNS = ("capital_country", "capital_name", "capital_cca2")


def capitals_dim(countries: DataFrame, strict: bool = False) -> DataFrame:
    """Capitals ``{country, cca2, capital, lat, lon}`` of usable countries.

    Default rule: a non-empty alpha_2 and a capital latitude. ``strict``
    (the survey's rule) also needs a non-empty country name and the
    longitude; a capital entry must exist, which the coordinates imply.
    """
    cond = (F.col("alpha_2").isNotNull() & (F.col("alpha_2") != "")
            & F.col("capital_lat").isNotNull())
    if strict:
        cond = (cond & F.col("country_name").isNotNull() & (F.col("country_name") != "")
                & F.col("capital_lon").isNotNull())
    return countries.where(cond).select(
        F.col("country_name").alias("country"), F.col("alpha_2").alias("cca2"),
        F.col("capital_name").alias("capital"), F.col("capital_lat").alias("lat"),
        F.col("capital_lon").alias("lon"))


def filter_capitals(capitals: DataFrame, codes: str | Iterable[str] | None = None,
                    limit: int = 0) -> DataFrame:
    """Allow-list by ISO code (comma text or list; empty = all), then the
    first ``limit`` capitals by code (0 = all)."""
    wanted = parse_code_list(codes) if isinstance(codes, str) or codes is None else [
        c.strip().upper() for c in codes if c and c.strip()]
    out = capitals.where(F.col("cca2").isin(wanted)) if wanted else capitals
    if limit and limit > 0:
        out = out.orderBy("cca2").limit(int(limit))
    return out


def _capital_boxes(capitals: DataFrame, h: float, cell: float) -> DataFrame:
    boxes = capitals.select(
        F.col("country").alias("capital_country"), F.col("cca2").alias("capital_cca2"),
        F.col("capital").alias("capital_name"), F.col("lat").alias("capital_lat"),
        F.col("lon").alias("capital_lon"),
        (F.col("lat") - h).alias("min_lat"), (F.col("lat") + h).alias("max_lat"),
        (F.col("lon") - h).alias("min_lon"), (F.col("lon") + h).alias("max_lon"))
    return (boxes
            .withColumn("cell_lat", F.explode(F.sequence(F.floor(F.col("min_lat") / cell),
                                                         F.floor(F.col("max_lat") / cell))))
            .withColumn("cell_lon", F.explode(F.sequence(F.floor(F.col("min_lon") / cell),
                                                         F.floor(F.col("max_lon") / cell)))))


def bbox_match(capitals: DataFrame, stations: DataFrame,
               half_width: float = K.BBOX_HALF_WIDTH, same_country: bool = False,
               cell_size: float | None = None, max_per_capital: int | None = None
               ) -> DataFrame:
    """Pair each station with every capital whose box contains it (inclusive).

    Output: the station columns with ``capital_country / capital_name /
    capital_cca2`` filled from the capital, plus ``capital_lat/lon``. A
    station inside two overlapping boxes yields two rows.

    ``same_country`` adds the documented ISO rule ``country_code <=> cca2``.
    ``max_per_capital`` keeps the first n stations per capital by id (the
    page size of the original station search); None keeps all.
    """
    h = float(half_width)
    cell = float(cell_size or 2 * h)
    boxes = broadcast_if_bounded(_capital_boxes(capitals, h, cell),
                                 MAX_BROADCAST_CAPITAL_CELLS)
    st = stations.drop(*[c for c in TAG_COLUMNS if c in stations.columns])
    st = (st.withColumn("cell_lat", F.floor(F.col("latitude") / cell))
            .withColumn("cell_lon", F.floor(F.col("longitude") / cell)))
    cond = ((st["cell_lat"] == boxes["cell_lat"]) & (st["cell_lon"] == boxes["cell_lon"])
            & st["latitude"].between(boxes["min_lat"], boxes["max_lat"])
            & st["longitude"].between(boxes["min_lon"], boxes["max_lon"]))
    if same_country:
        cond = cond & st["country_code"].eqNullSafe(boxes["capital_cca2"])
    pairs = st.join(boxes, cond, "inner")
    out_cols = [c for c in stations.columns if c not in TAG_COLUMNS]
    out = pairs.select(*[st[c] for c in out_cols],
                       *[boxes[c] for c in TAG_COLUMNS],
                       boxes["capital_lat"], boxes["capital_lon"])
    if max_per_capital:
        # row_number() <= n plans a WindowGroupLimit, which trims each map
        # partition before the shuffle, so a crowded capital stays cheap.
        w = Window.partitionBy("capital_cca2").orderBy("location_id")
        out = (out.withColumn("__n", F.row_number().over(w))
                  .where(F.col("__n") <= int(max_per_capital)).drop("__n"))
    return out


def active_only(pairs: DataFrame, as_of, within_days: int = K.ACTIVE_WITHIN_DAYS,
                column: str = "datetime_last_utc") -> DataFrame:
    """Stations that reported within ``within_days`` of ``as_of``."""
    return pairs.where(is_active(column, as_of, within_days))


def one_capital_per_station(pairs: DataFrame) -> DataFrame:
    """Merge by ``location_id`` when overlapping boxes tagged a station twice:
    latest ``ingested_at``, then the nearest capital, then the smaller code."""
    dist = ((F.col("latitude") - F.col("capital_lat")) ** 2
            + (F.col("longitude") - F.col("capital_lon")) ** 2)
    return pick_per_key(pairs, ["location_id"],
                        [newest_first("ingested_at"), dist, F.col("capital_cca2")])


def tag_stations(capitals: DataFrame, stations: DataFrame, as_of,
                 same_country: bool = False, max_per_capital: int | None = None
                 ) -> DataFrame:
    """``raw.locations`` as the ingestion builds it: active stations in a
    capital's box, one row per station, with the capital's tags."""
    pairs = bbox_match(capitals, stations, same_country=same_country,
                       max_per_capital=max_per_capital)
    return one_capital_per_station(active_only(pairs, as_of)).drop("capital_lat", "capital_lon")
