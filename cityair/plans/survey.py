"""Per-capital coverage survey (stations in the box, active ones, dates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityair.functions import constants as K
from cityair.functions.expressions import count_where, is_active
from cityair.operators.geo import bbox_match
from cityair.sources.payloads import flatten_locations


# A report row holds an error's text up to this many characters.
ERROR_TEXT_CHARS = 500
_COUNTS = ("total_locations", "active_locations", "sensors_total")
_DATES = ("earliest_data", "latest_data")


def _per_capital(pairs: DataFrame, as_of) -> DataFrame:
    """Stations of each capital reduced to one row. Dates span all stations of
    the capital, not only active ones."""
    return (pairs.groupBy(F.col("capital_cca2").alias("cca2"))
            .agg(F.count(F.lit(1)).alias("total_locations"),
                 count_where(is_active("datetime_last_utc", as_of)).alias("active_locations"),
                 F.to_date(F.min("datetime_first_utc")).alias("earliest_data"),
                 F.to_date(F.max("datetime_last_utc")).alias("latest_data"),
                 F.sum(F.coalesce("sensor_count", F.lit(0))).cast("long").alias("sensors_total")))


def _survey_rows(capitals: DataFrame, per_cap: DataFrame, errors: DataFrame | None) -> DataFrame:
    """The capital list with its numbers: zeros without stations, NULLs and
    the error's text where the capital's fetch failed."""
    rows = capitals.join(per_cap, "cca2", "left")
    if errors is None:
        rows = rows.withColumn("error", F.lit(None).cast("string"))
    else:
        rows = rows.join(errors.select("cca2", "error"), "cca2", "left")
    known = F.col("error").isNull()
    count = {c: F.when(known, F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in _COUNTS}
    date = {c: F.when(known, F.col(c)).alias(c) for c in _DATES}
    out = rows.select("country", "cca2", "capital", count["total_locations"],
                      count["active_locations"], date["earliest_data"], date["latest_data"],
                      count["sensors_total"], "error")
    return out.orderBy(F.desc_nulls_last("active_locations"), F.desc_nulls_last("sensors_total"),
                       "cca2")


def capital_survey(capitals: DataFrame, stations: DataFrame, as_of,
                   half_width: float = K.BBOX_HALF_WIDTH,
                   max_per_capital: int | None = None,
                   errors: DataFrame | None = None) -> DataFrame:
    """One row per capital, capitals without stations included (zeros).

    ``stations`` needs ``sensor_count`` (see ``flatten_locations``). Dates
    span all stations in the box, not only active ones. Pairs are reduced
    per capital first, then left-joined to the capital list on its code.
    ``max_per_capital`` counts only the first n stations per capital (one
    page of the station search); None counts all. ``errors`` (cca2, error)
    names capitals whose stations could not be fetched: their numbers are
    NULL and the text stands in ``error``.
    """
    pairs = bbox_match(capitals, stations, half_width=half_width,
                       max_per_capital=max_per_capital)
    return _survey_rows(capitals, _per_capital(pairs, as_of), errors)


def fetch_errors(pages: DataFrame, quarantine: DataFrame,
                 max_chars: int = ERROR_TEXT_CHARS) -> DataFrame:
    """(cca2, error): one row a capital with a failed request or a malformed
    record, found by the folder the line was landed in. The text is that of
    the first problem (requests before records, then by text), with the
    number of further ones. All aggregates combine map-side, so a capital
    with a million bad lines is one row a task."""
    failed = pages.where(F.col("error").isNotNull()).select(
        F.col("capital_cca2").alias("cca2"), F.lit(0).alias("kind"),
        F.col("error").alias("text"))
    malformed = quarantine.select(
        F.col("capital_cca2").alias("cca2"), F.lit(1).alias("kind"),
        F.concat(F.lit("malformed record: "), F.col("raw_record")).alias("text"))
    each = failed.unionByName(malformed).withColumn("text", F.substring("text", 1, max_chars))
    more = F.col("n") - 1
    return (each.groupBy("cca2").agg(F.min(F.struct("kind", "text")).alias("first"),
                                     F.count(F.lit(1)).alias("n"))
                .select("cca2", F.concat(
                    F.col("first.text"),
                    F.when(more > 0, F.concat(F.lit(" (and "), more.cast("string"),
                                              F.lit(" more)"))).otherwise(F.lit("")))
                        .alias("error")))


def survey_pages(capitals: DataFrame, pages: DataFrame, quarantine: DataFrame, as_of) -> DataFrame:
    """The survey over landed station searches (``payloads.read_station_pages``):
    a capital's stations are the ones fetched for it, and a capital whose
    request failed or whose records did not parse keeps its row with the
    error's text and NULL numbers; the others are as if nothing had happened."""
    errors = fetch_errors(pages, quarantine)
    found = flatten_locations(pages.where(F.col("error").isNull()), with_sensor_count=True)
    return _survey_rows(capitals, _per_capital(found, as_of), errors)


def covered_capitals(survey: DataFrame, n: int = K.TOP_N_BARS) -> DataFrame:
    """Capitals with at least one active station, top ``n`` by the survey order."""
    return (survey.where(F.col("active_locations") > 0)
                  .orderBy(F.desc_nulls_last("active_locations"),
                           F.desc_nulls_last("sensors_total"), "cca2")
                  .limit(n)
                  .select("country", "capital", "active_locations", "sensors_total",
                          "earliest_data"))


def survey_summary(survey: DataFrame) -> DataFrame:
    a = F.col("active_locations")
    return survey.agg(
        F.count(F.lit(1)).alias("capitals_surveyed"),
        count_where(F.col("total_locations") > 0).alias("with_any_data"),
        count_where(a > 0).alias("with_active"),
        F.coalesce(F.sum(F.when(a > 0, a)), F.lit(0)).cast("long").alias("total_active"))


def active_per_capital(pairs: DataFrame, as_of) -> DataFrame:
    return (pairs.where(is_active("datetime_last_utc", as_of))
                 .groupBy("capital_cca2", "capital_name")
                 .agg(F.count(F.lit(1)).alias("active_locations")))


def rows_per_sensor(measurements: DataFrame) -> DataFrame:
    return measurements.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("rows"))


def run_survey(capitals: DataFrame, stations: DataFrame | None, as_of, report_path: str,
               n: int = K.TOP_N_BARS, pages: tuple[DataFrame, DataFrame] | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Write the survey report (CSV with header) and return
    ``(summary, top covered capitals)``; all three come from one survey plan.

    With ``pages`` (pages, quarantine) the stations are those landed a capital,
    and capitals with errors are reported as such."""
    from cityair.sources.sinks import write_report_csv

    s = (capital_survey(capitals, stations, as_of) if pages is None
         else survey_pages(capitals, *pages, as_of))
    write_report_csv(s, report_path)
    return survey_summary(s), covered_capitals(s, n)
