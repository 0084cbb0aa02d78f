"""Command line: ``python -m cityair <step> ...``.

  ingest   landed countries / stations / day readings -> upserted raw tables
  build    raw tables -> staging, city-day table (partitioned by pollutant)
  check    the seventeen data-quality checks; exit code 1 when any fails
  survey   per-capital coverage report (CSV) and its summary

The master and every other Spark setting come from the usual
``spark-submit`` / ``spark-defaults.conf`` configuration.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _spark() -> SparkSession:
    spark = SparkSession.builder.appName("cityair").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cityair")
    sub = ap.add_subparsers(dest="step", required=True)
    ing = sub.add_parser("ingest", help="landed files -> upserted raw tables")
    ing.add_argument("--countries", required=True)
    ing.add_argument("--locations", required=True)
    ing.add_argument("--days", required=True)
    ing.add_argument("--raw", required=True, help="raw tables folder")
    ing.add_argument("--run-ts", required=True)
    ing.add_argument("--as-of", required=True)
    ing.add_argument("--capitals", default="", help="comma list of ISO codes (empty = all)")
    ing.add_argument("--capitals-limit", type=int, default=0)
    ing.add_argument("--window-days", type=int, default=None)
    ing.add_argument("--same-country", action="store_true")
    helps = {"build": "raw tables -> staging and the city-day table",
             "check": "the seventeen data-quality checks (exit 1 on failure)"}
    for name in ("build", "check"):
        p = sub.add_parser(name, help=helps[name])
        p.add_argument("--raw", required=True)
        p.add_argument("--table", default=None, help="city-day table path")
    sv = sub.add_parser("survey", help="per-capital coverage report (CSV) and summary")
    sv.add_argument("--countries", required=True)
    src = sv.add_mutually_exclusive_group(required=True)
    src.add_argument("--locations", help="landed station objects, matched to capitals by box")
    src.add_argument("--pages", help="station searches landed a capital (capital_cca2=XX/); "
                                     "failed and malformed ones are reported")
    sv.add_argument("--as-of", required=True)
    sv.add_argument("--report", required=True)
    a = ap.parse_args(argv)

    from cityair import flow
    spark = _spark()
    if a.step == "ingest":
        raw = flow.ingest(spark, a.countries, a.locations, a.days, a.raw, a.run_ts, a.as_of,
                          capital_codes=a.capitals, capital_limit=a.capitals_limit,
                          same_country=a.same_country, window_days=a.window_days)
        for name, df in raw.items():
            print(name, df.count())
        return 0
    if a.step in ("build", "check"):
        models = flow.build(spark, flow.read_raw(spark, a.raw), a.table)
        if a.step == "build":
            models.kpi_summary.show(truncate=False)
            return 0
        from cityair.operators import quality
        rows = quality.run_suite(models.as_dict(), quality.reference_checks()).collect()
        for r in rows:
            print(f"{'PASS' if r.passed else 'FAIL'} {r.check_name} ({r.failing_rows})")
        return 0 if all(r.passed for r in rows) else 1
    from cityair import schemas
    from cityair.operators import geo
    from cityair.plans import survey
    from cityair.sources import payloads
    caps = geo.capitals_dim(payloads.read_countries(spark, a.countries), strict=True)
    if a.pages:
        summary, top = survey.run_survey(caps, None, a.as_of, a.report,
                                         pages=payloads.read_station_pages(spark, a.pages))
    else:
        stations = payloads.flatten_locations(payloads.read_json(
            spark, a.locations, schemas.LOCATION_PAYLOAD), with_sensor_count=True)
        summary, top = survey.run_survey(caps, stations, a.as_of, a.report)
    summary.show(truncate=False)
    top.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
