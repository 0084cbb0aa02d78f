"""Each data-quality check passes on clean data and fires on a seeded defect."""

import datetime as dt

from pyspark.sql import functions as F

from cityair import schemas
from cityair.operators import quality
from cityair.catalog import world
from conftest import SF0001

D = dt.datetime(2024, 1, 1)


def test_reference_suite_passes_on_stand_ins(spark):
    from cityair.catalog import QUERIES
    rows = QUERIES["dq_suite"](spark, SF0001).collect()
    assert len(rows) == 17 and all(r.passed for r in rows)


def _stg(spark, rows):
    return spark.createDataFrame(rows, schemas.STG_AIR_QUALITY)


def test_suite_fires_on_defects(spark):
    good = ("id1", "A", "X", "pm25", 1.0, 1.0, "ug/m3", D, 100.0)
    rows = [good,
            ("id1", "B", "X", "pm25", 1.0, 1.0, "ug/m3", D, 100.0),      # duplicate id
            (None, None, "X", "temperature", -1.0, 1.0, "ug/m3", D, 100.0),  # 4 defects
            ("id3", "C", "X", None, None, 1.0, "ug/m3", D, 100.0)]       # null param + value
    checks = [c for c in quality.reference_checks() if c.model == "stg_air_quality"]
    out = {r.check_name: r.failing_rows
           for r in quality.run_suite({"stg_air_quality": _stg(spark, rows)}, checks).collect()}
    assert out == {
        "not_null_stg_air_quality_measurement_id": 1,
        "unique_stg_air_quality_measurement_id": 1,
        "not_null_stg_air_quality_city": 1,
        "not_null_stg_air_quality_parameter": 1,
        "accepted_values_stg_air_quality_parameter": 1,   # NULL passes, 'temperature' fails
        "not_null_stg_air_quality_value": 1,
        "assert_value_non_negative": 1,
    }


def test_single_checks_return_failing_rows(spark):
    df = _stg(spark, [("a", "A", "X", "pm25", 1.0, 1.0, "u", D, 1.0),
                      ("a", None, "X", "bad", -2.0, 1.0, "u", D, 1.0)])
    assert quality.not_null_failures(df, "city").count() == 1
    assert quality.unique_failures(df, "measurement_id").first().n_records == 2
    assert quality.accepted_values_failures(df, "parameter").first().parameter == "bad"
    assert quality.expression_failures(df, F.col("value") < 0).count() == 1


def test_profile_counts_match_fixture(spark):
    w = world(spark, SF0001)
    r = quality.quality_profile(w.measurements).first()
    assert (r.total_rows, r.null_values, r.negative_values, r.over_range_values,
            r.below_completeness, r.non_target) == (792, 6, 8, 5, 382, 69)


def test_cross_border_is_null_aware(spark):
    from helpers import location
    locs = spark.createDataFrame([location(1, "a", cca2="AA", code="AA"),
                                  location(2, "b", cca2="AA", code="BB"),
                                  location(3, "c", cca2="AA", code=None),
                                  location(4, "d", cca2=None, code=None)], schemas.LOCATIONS)
    assert quality.cross_border_count(locs).first().cross_border_stations == 2
    r = quality.mismatch_rates(locs).first()
    assert r.code_mismatch_rate == 0.5


def test_landing_the_raw_layer_changes_no_result(spark):
    """Queries over the landed Parquet raw layer equal the same plans run
    straight from the test tables."""
    from cityair.catalog import BUILDERS, World, rounded
    lazy = World(spark, SF0001, land_raw=False)
    landed = world(spark, SF0001)
    for name in ("stg_air_quality", "pollution_ranking", "capital_survey", "monthly_top15",
                 "quality_profile", "tagged_stations"):
        a = rounded(BUILDERS[name](lazy))
        b = rounded(BUILDERS[name](landed))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
