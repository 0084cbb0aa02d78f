"""Payload flattening, capitals, and the box match."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cityair import schemas
from cityair.operators import geo
from cityair.sources import payloads, standins as S
from conftest import SF001, SF0001
from helpers import location

RUN = "2024-01-31 00:00:00"


def _write_lines(folder, name, objs, extra_lines=()):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")
        for line in extra_lines:
            f.write(line + "\n")


def test_flatten_countries_primary_capital_rules(spark, scratch):
    objs = [
        {"names": {"common": "A"}, "codes": {"alpha_2": "AA"},
         "capitals": [{"name": "a2", "coordinates": {"lat": 1, "lng": 2}, "attributes": {"primary": False}},
                      {"name": "a1", "coordinates": {"lat": 3, "lng": 4}, "attributes": {"primary": True}}]},
        {"names": {"common": "B"}, "codes": {"alpha_2": "BB"},
         "capitals": [{"name": "b1", "coordinates": {"lat": 5, "lng": 6}}]},
        {"names": {"common": "C"}, "codes": {"alpha_2": "CC"}, "capitals": []},
        {"names": {"common": "D"}, "codes": {"alpha_2": ""}, "capitals": []},
        {"names": {"common": "E"}},
        {"names": {"common": "F"}, "codes": {"alpha_2": "FF"},
         "capitals": [{"name": "f1", "attributes": {"primary": True}}]},
    ]
    _write_lines(scratch, "countries.json", objs)
    c = payloads.read_countries(spark, scratch, RUN)
    rows = {r.alpha_2: r for r in c.collect()}
    assert set(rows) == {"AA", "BB", "CC", "FF"}  # empty / missing alpha_2 dropped
    assert (rows["AA"].capital_name, rows["AA"].capital_lat) == ("a1", 3.0)
    assert rows["BB"].capital_name == "b1"  # no primary flag -> first
    assert rows["CC"].capital_name is None
    caps = {r.cca2 for r in geo.capitals_dim(c).collect()}
    assert caps == {"AA", "BB"}  # FF has no coordinates
    assert {r.cca2 for r in geo.capitals_dim(c, strict=True).collect()} == {"AA", "BB"}


def test_flatten_locations_missing_objects_and_sensor_explode(spark, scratch):
    objs = [
        {"id": 1, "name": "s1", "country": {"code": "AA"}, "coordinates": {"latitude": 1.0},
         "datetimeLast": {"utc": "2024-01-02T03:04:05Z"},
         "sensors": [{"id": 11, "parameter": {"name": "pm25", "units": "µg/m³"}}, {"id": 12}]},
        {"id": 2, "sensors": None},
        {"id": 3, "sensors": [], "datetimeLast": {"utc": "2024-01-02T05:04:05+02:00"}},
    ]
    _write_lines(scratch, "loc.json", objs)
    raw = payloads.read_json(spark, scratch, schemas.LOCATION_PAYLOAD)
    locs = {r.location_id: r for r in payloads.flatten_locations(raw, RUN).collect()}
    assert locs[1].country_code == "AA" and locs[1].longitude is None
    assert locs[1].datetime_last_utc == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert locs[3].datetime_last_utc == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert locs[2].country_code is None and locs[2].capital_name is None
    sens = payloads.explode_sensors(raw, RUN).collect()
    assert sorted(r.sensor_id for r in sens) == [11, 12]
    assert {r.sensor_id: r.parameter_name for r in sens} == {11: "pm25", 12: None}


def test_quarantine_keeps_good_rows(spark, scratch):
    _write_lines(scratch, "loc.json", [{"id": 1}, {"id": 2}], extra_lines=["{not json"])
    good, bad = payloads.read_json_with_quarantine(spark, scratch, schemas.LOCATION_PAYLOAD)
    assert sorted(r.id for r in good.collect()) == [1, 2]
    rows = bad.collect()
    assert len(rows) == 1 and rows[0].raw_record == "{not json"


def test_nested_payload_roundtrip_through_json(spark, scratch):
    """Stand-in payloads written as JSON lines and read back flatten the same."""
    p = S.location_payloads(spark, SF0001, True)
    p.write.mode("overwrite").json(scratch + "/locs")
    tags = [(t, StringType()) for t in ("capital_country", "capital_name", "capital_cca2")]
    back = payloads.read_json(spark, scratch + "/locs",
                              schemas.with_fields(schemas.LOCATION_PAYLOAD, *tags))
    a = payloads.flatten_locations(back, RUN)
    b = S.locations(spark, SF0001)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _nested_loop(capitals, stations, h=0.3):
    c = capitals.alias("c")
    s = stations.alias("s")
    return s.join(c, F.col("s.latitude").between(F.col("c.lat") - h, F.col("c.lat") + h)
                  & F.col("s.longitude").between(F.col("c.lon") - h, F.col("c.lon") + h)) \
            .select(F.col("s.location_id"), F.col("c.cca2").alias("capital_cca2"))


def test_grid_join_equals_nested_loop(spark):
    caps = S.capitals(spark, SF001)
    st = S.stations(spark, SF001)
    grid = geo.bbox_match(caps, st).select("location_id", "capital_cca2")
    brute = _nested_loop(caps, st)
    assert grid.count() == 2095
    assert grid.exceptAll(brute).count() == 0 and brute.exceptAll(grid).count() == 0
    multi = grid.groupBy("location_id").count().where("count > 1").count()
    assert multi > 0  # overlapping boxes: a station can match two capitals


def test_grid_join_other_cell_sizes_and_edges(spark):
    caps = spark.createDataFrame([("X", "XX", "x", 0.0, 0.0), ("Y", "YY", "y", 0.5, 0.0)],
                                 schemas.CAPITALS)
    pts = [(i, round(-0.6 + 0.05 * i, 10), 0.3) for i in range(30)] + [(99, -0.3, -0.3)]
    st = spark.createDataFrame([location(i, None, lat=a, lon=b) for i, a, b in pts],
                               schemas.LOCATIONS)
    brute = {tuple(r) for r in _nested_loop(caps, st).collect()}
    for cell in (None, 0.1, 0.25, 1.7):
        got = {tuple(r) for r in geo.bbox_match(caps, st, cell_size=cell)
               .select("location_id", "capital_cca2").collect()}
        assert got == brute


def test_same_country_and_page_cap(spark):
    caps = S.capitals(spark, SF001)
    st = S.stations(spark, SF001)
    assert geo.bbox_match(caps, st, same_country=True).count() == 1130
    capped = geo.bbox_match(caps, st, max_per_capital=10)
    per = {r.capital_cca2: r["count"] for r in capped.groupBy("capital_cca2").count().collect()}
    assert max(per.values()) == 10


def test_active_window_and_station_dedup(spark):
    caps = spark.createDataFrame([("X", "XX", "x", 0.0, 0.0), ("Y", "YY", "y", 0.5, 0.0)],
                                 schemas.CAPITALS)
    last_ok = dt.datetime(2023, 12, 31)  # exactly 30 days before as_of: active
    st = spark.createDataFrame(
        [location(1, None, lat=0.2, lon=0.0, last=last_ok),
         location(2, None, lat=0.3, lon=0.0, last=last_ok),
         location(3, None, lat=0.0, lon=0.0, last=dt.datetime(2023, 12, 30)),
         location(4, None, lat=0.0, lon=0.0, last=None)], schemas.LOCATIONS)
    tagged = {r.location_id: r.capital_cca2
              for r in geo.tag_stations(caps, st, "2024-01-30 00:00:00").collect()}
    assert tagged == {1: "XX", 2: "YY"}  # in both boxes: the nearest capital wins


def test_capitals_filter_and_limit(spark):
    caps = S.capitals(spark, SF0001)
    got = [r.cca2 for r in geo.filter_capitals(caps, " n1, N3,,n7 ,N12, n20 ", 3).collect()]
    assert got == ["N1", "N12", "N20"]
    assert geo.filter_capitals(caps, "", 0).count() == caps.count()


def test_survey_zero_station_capital(spark):
    from cityair.plans import survey
    s = survey.capital_survey(S.capitals(spark, SF001), S.stations(spark, SF001, with_sensor_count=True),
                              S.AS_OF)
    rows = {r.cca2: r for r in s.collect()}
    assert len(rows) == 26
    assert rows["ZZ"].total_locations == 0 and rows["ZZ"].earliest_data is None
    summ = survey.survey_summary(s).first()
    assert (summ.capitals_surveyed, summ.with_any_data, summ.with_active, summ.total_active) == \
        (26, 25, 25, 1084)


def test_survey_page_cap_option(spark):
    from cityair.plans import survey
    caps, st = S.capitals(spark, SF001), S.stations(spark, SF001, with_sensor_count=True)
    full = {r.cca2: r.total_locations for r in survey.capital_survey(caps, st, S.AS_OF).collect()}
    capped = {r.cca2: r.total_locations
              for r in survey.capital_survey(caps, st, S.AS_OF, max_per_capital=50).collect()}
    assert all(capped[k] == min(v, 50) for k, v in full.items())


def test_ingest_stations_one_parse(spark, scratch):
    p = S.location_payloads(spark, SF0001, True)
    p.write.mode("overwrite").json(scratch + "/locs")
    locs, sens = payloads.ingest_stations(
        spark, scratch + "/locs", RUN, tags=("capital_country", "capital_name", "capital_cca2"))
    want_l, want_s = S.locations(spark, SF0001), payloads.explode_sensors(p, RUN)
    assert locs.exceptAll(want_l).count() == 0 and want_l.exceptAll(locs).count() == 0
    assert sens.exceptAll(want_s).count() == 0 and sens.count() == want_s.count()
    scan = sens._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in scan and "FileScan json" not in scan
