"""Staging rules on hand-written rows, one trap at a time."""

import hashlib

import pytest

from cityair.plans import marts, staging
from cityair.sources import seeds
from helpers import DAY, frames, location, measurement, sensor


def stg_of(spark, meas, sens=None, locs=None):
    sens = sens or [sensor(m[0], 1) for m in meas]
    locs = locs or [location(1, "Athens")]
    m, s, l = frames(spark, meas, sens, locs)
    return staging.stg_air_quality(m, s, l, seeds.molecular_weights(spark))


def test_worked_example_40_ppb_no2(spark):
    row = stg_of(spark, [measurement(1, 40.0, "NO2", "ppb")]).first()
    assert row.value == pytest.approx(40 * 46.0055 / 24.45)
    assert round(row.value, 1) == 75.3
    assert row.unit == "ug/m3" and row.parameter == "no2"


def test_ppm_conversion_and_pass_through(spark):
    rows = {r.parameter: r.value for r in stg_of(spark, [
        measurement(1, 2.0, "co", "ppm"), measurement(2, 7.0, "pm25", "µg/m³")]).collect()}
    assert rows["co"] == pytest.approx(2.0 * 28.01 * 1000 / 24.45)
    assert rows["pm25"] == 7.0


def test_particulates_in_ppm_give_null_value_but_stay(spark):
    # T10: no molecular weight -> NULL value, row kept and counted.
    stg = stg_of(spark, [measurement(1, 5.0, "pm25", "ppm")])
    row = stg.first()
    assert row.value is None
    cda = marts.city_daily_avg(stg).first()
    assert cda.num_readings == 1 and cda.avg_value is None


def test_over_range_drops_any_unit(spark):
    # T5: >= 10000 goes, whatever the unit.
    stg = stg_of(spark, [measurement(1, 10000.0, "pm25", "µg/m³"),
                         measurement(2, 10000.0, "co", "ppb"),
                         measurement(3, 9999.0, "pm25", "µg/m³")])
    assert [r.value for r in stg.collect()] == [9999.0]


def test_ppb_cap_is_dead_at_defaults(spark):
    # T3: a ppb value above 50000 is already outside the range rule.
    j = stg_of(spark, [measurement(1, 9999.0, "no2", "ppb"),
                       measurement(2, 60000.0, "no2", "ppb")])
    assert j.count() == 1


def test_null_unit_three_valued_logic(spark):
    # M13: NULL unit and value > 50 -> NULL predicate -> dropped; <= 50 kept.
    stg = stg_of(spark, [measurement(1, 60.0, "no2", None), measurement(2, 40.0, "no2", None)])
    assert [r.value for r in stg.collect()] == [40.0]


def test_ppm_cap(spark):
    stg = stg_of(spark, [measurement(1, 51.0, "co", "ppm"), measurement(2, 50.0, "co", "ppm")])
    assert stg.count() == 1


def test_null_negative_incomplete_non_target_and_no_city(spark):
    meas = [measurement(1, None), measurement(2, -1.0), measurement(3, 5.0, pct=74.9),
            measurement(4, 5.0, parameter="temperature"), measurement(5, 5.0),
            measurement(6, 5.0, pct=75.0)]
    sens = [sensor(i, 1) for i in range(1, 5)] + [sensor(5, 2), sensor(6, 1)]
    locs = [location(1, "Athens"), location(2, None)]
    stg = stg_of(spark, meas, sens, locs)
    assert stg.count() == 1  # only sensor 6 (75 % is enough) survives


def test_surrogate_key_text(spark):
    row = stg_of(spark, [measurement(123, 1.0, "pm25", "µg/m³")]).first()
    assert row.measurement_id == hashlib.md5(b"123-2024-01-02 00:00:00+00").hexdigest()


def test_clip_mode_keeps_over_range(spark):
    m, s, l = frames(spark, [measurement(1, 12000.0, "pm25", "µg/m³")], [sensor(1, 1)],
                     [location(1, "Athens")])
    out = staging.stg_air_quality(m, s, l, seeds.molecular_weights(spark), over_range="clip")
    assert [r.value for r in out.collect()] == [10000.0]


def test_seed_csv_reads_empty_as_null(spark, scratch):
    path = scratch + "/weights.csv"
    with open(path, "w") as f:
        f.write(seeds.seed_csv_text())
    rows = {r.parameter: r.molecular_weight_g_per_mol
            for r in seeds.read_seed_csv(spark, path).collect()}
    assert rows["no2"] == 46.0055 and rows["pm25"] is None and len(rows) == 6
    inline = {r.parameter: r.molecular_weight_g_per_mol
              for r in seeds.molecular_weights(spark).collect()}
    assert inline == rows


def test_city_is_capital_country_is_station(spark):
    # M5: a city can split over two countries.
    stg = stg_of(spark, [measurement(1, 5.0, "pm25", "µg/m³"), measurement(2, 7.0, "pm25", "µg/m³")],
                 [sensor(1, 1), sensor(2, 2)],
                 [location(1, "Rome", country="Italy"), location(2, "Rome", country="Vatican")])
    cda = marts.city_daily_avg(stg)
    assert cda.count() == 2


def test_city_daily_is_unweighted_average_of_sensor_days(spark):
    stg = stg_of(spark, [measurement(1, 10.0, "pm25", "µg/m³"), measurement(2, 20.0, "pm25", "µg/m³",
                                                                            value_max=50.0)])
    r = marts.city_daily_avg(stg).first()
    assert (r.avg_value, r.max_value, r.num_readings) == (15.0, 50.0, 2)
    assert str(r.reading_date) == str(DAY.date())
