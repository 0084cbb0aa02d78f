"""Survey rows of failed capitals, and the completion ledger of paged loads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cityair import flow, schemas
from cityair.__main__ import main
from cityair.operators import geo, ledger
from cityair.plans import survey
from cityair.sources import payloads, standins as S
from conftest import SF0001


def station(i, last="2024-01-29T00:00:00Z", sensors=1):
    return {"id": i, "name": f"s{i}", "datetimeFirst": {"utc": "2020-01-01T00:00:00Z"},
            "datetimeLast": {"utc": last},
            "sensors": [{"id": 10 * i + k} for k in range(sensors)]}


def land(folder, pages):
    for code, lines in pages.items():
        os.makedirs(f"{folder}/capital_cca2={code}", exist_ok=True)
        with open(f"{folder}/capital_cca2={code}/page.json", "w") as f:
            f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)


PAGES = {
    "AA": [station(1, sensors=2), station(2, last="2020-01-01T00:00:00Z")],
    "BB": [station(3), '{"id": 4, "name": "cut', station(5)],
    "CC": [{"error": "503 Server Error"}],
    "DD": ['{"b', "not json", station(6)],
    "FF": [station(1, sensors=2)],  # a station of two boxes
}


def capitals(spark):
    return spark.createDataFrame([(f"C{c}", c, f"Cap {c}", 0.0, 0.0) for c in
                                  ("AA", "BB", "CC", "DD", "EE", "FF")], schemas.CAPITALS)


def test_failed_capitals_keep_their_row_with_the_error(spark, scratch):
    land(scratch, PAGES)
    pages, bad = payloads.read_station_pages(spark, scratch, f"{scratch}-quarantine")
    rows = survey.survey_pages(capitals(spark), pages, bad, S.AS_OF).collect()
    got = {r.cca2: (r.total_locations, r.active_locations, r.sensors_total, r.error) for r in rows}
    assert got == {
        "AA": (2, 1, 3, None), "EE": (0, 0, 0, None), "FF": (1, 1, 2, None),
        "BB": (None, None, None, 'malformed record: {"id": 4, "name": "cut'),
        "CC": (None, None, None, "503 Server Error"),
        "DD": (None, None, None, "malformed record: not json (and 1 more)")}
    failed = [r for r in rows if r.error]
    assert all(r.earliest_data is None and r.latest_data is None for r in failed)
    assert [r.cca2 for r in rows[-3:]] == ["BB", "CC", "DD"]  # NULL numbers sort last
    summary = survey.survey_summary(survey.survey_pages(
        capitals(spark), pages, bad, S.AS_OF)).first()
    assert tuple(summary) == (6, 2, 2, 2)
    kept = spark.read.parquet(f"{scratch}-quarantine")
    assert kept.count() == 3 and set(kept.columns) == {"raw_record", "source_file",
                                                       "capital_cca2"}


def test_one_failure_leaves_the_other_capitals_alone(spark, scratch):
    whole, cut = f"{scratch}/whole", f"{scratch}/cut"
    fine = {c: [x for x in lines if isinstance(x, dict) and "id" in x]
            for c, lines in PAGES.items()}
    land(whole, fine)
    land(cut, {**fine, "AA": ["{"]})
    read = lambda p: {r.cca2: tuple(r) for r in survey.survey_pages(
        capitals(spark), *payloads.read_station_pages(spark, p), S.AS_OF).collect()}
    a, b = read(whole), read(cut)
    assert b.pop("AA")[-1] == "malformed record: {" and a.pop("AA")[-1] is None
    assert a == b


def test_long_error_texts_are_cut_and_pages_of_no_capital_ignored(spark, scratch):
    land(scratch, {"AA": ['{"id": 1, "name": "' + "x" * 5000], "ZZ": ["{"]})
    pages, bad = payloads.read_station_pages(spark, scratch)
    errors = survey.fetch_errors(pages, bad, max_chars=40)
    assert {r.cca2: len(r.error) for r in errors.collect()} == {"AA": 40, "ZZ": 19}
    rows = survey.survey_pages(capitals(spark), pages, bad, S.AS_OF).collect()
    assert len(rows) == 6 and [r.cca2 for r in rows if r.error] == ["AA"]


def test_box_survey_takes_errors_too(spark):
    caps, st = S.capitals(spark, SF0001), S.stations(spark, SF0001, with_sensor_count=True)
    errors = spark.createDataFrame([("N3", "timed out")], "cca2 string, error string")
    plain = {r.cca2: tuple(r) for r in survey.capital_survey(caps, st, S.AS_OF).collect()}
    got = {r.cca2: tuple(r) for r in survey.capital_survey(
        caps, st, S.AS_OF, errors=errors).collect()}
    n3, want = got.pop("N3"), plain.pop("N3")
    assert got == plain and n3[:3] == want[:3] and n3[3:] == (None,) * 5 + ("timed out",)


def test_survey_command_reports_errors(spark, scratch):
    S.country_payloads(spark, SF0001).write.json(f"{scratch}/countries")
    pairs = geo.bbox_match(S.capitals(spark, SF0001), S.stations(spark, SF0001))
    S.land_station_pages(spark, SF0001, pairs, f"{scratch}/pages")
    assert main(["survey", "--countries", f"{scratch}/countries", "--pages", f"{scratch}/pages",
                 "--as-of", S.AS_OF, "--report", f"{scratch}/report"]) == 0
    report = spark.read.option("header", True).csv(f"{scratch}/report")
    assert report.count() == 26
    bad = {r.cca2 for r in report.where("error IS NOT NULL").collect()}
    assert "N7" in bad and "N18" in bad and "N4" in bad and "N1" not in bad


# ---- ledger ----

def reading(day, value=1.0):
    return {"value": value, "period": {"label": "1day", "datetimeFrom": {
        "utc": f"2024-01-{day:02d}T00:00:00Z"}}, "parameter": {"id": 1, "name": "pm25"}}


def page(sensor, number, days, error=None, ts="2024-01-31T00:00:00Z"):
    return {"sensor_id": sensor, "page": number, "ingested_at": ts, "error": error,
            "results": None if error else [reading(d) for d in days]}


def write_pages(folder, name, pages):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.writelines(json.dumps(p) + "\n" for p in pages)


def candidates(spark, *ids):
    return spark.createDataFrame([(i, i // 10) for i in ids], "sensor_id long, location_id long")


def states(df):
    return {r.sensor_id: (r.state, r.pages_loaded, r.rows_loaded) for r in df.collect()}


FIRST = [
    page(11, 1, [1, 2]), page(11, 2, [3]),                      # finished
    page(12, 1, []),                                            # finished, without readings
    page(13, 1, [1, 2]), page(13, 2, None, "504"),              # failed half-way
    page(14, 1, [1, 2]),                                        # stopped half-way
    page(15, 2, [3]),                                           # the first page is missing
    page(16, 1, [1, 2]), page(16, 2, []),                       # finished by an empty page
]


def test_pending_follows_the_ledger_through_restarts(spark, scratch):
    pages, raw = f"{scratch}/pages", f"{scratch}/raw"
    ask = candidates(spark, 11, 12, 13, 14, 15, 16, 17)
    run = lambda: flow.stream_day_pages(spark, pages, raw, f"{scratch}/ckpt", 2,
                                        max_files_per_trigger=1)
    assert set(states(flow.pending_sensors(spark, ask, raw)).values()) == {("new", 0, 0)}
    write_pages(pages, "a", FIRST)
    run()
    want = {13: ("failed", 1, 2), 14: ("half", 1, 2), 15: ("half", 1, 1), 17: ("new", 0, 0)}
    assert states(flow.pending_sensors(spark, ask, raw)) == want
    run()  # nothing new landed
    assert states(flow.pending_sensors(spark, ask, raw)) == want
    # A restart: the failed page succeeds, the missing ones come, one sensor is empty.
    write_pages(pages, "b", [page(13, 2, [3], ts="2024-02-01T00:00:00Z"), page(15, 1, [1, 2])])
    write_pages(pages, "c", [page(17, 1, [])])
    run()
    assert states(flow.pending_sensors(spark, ask, raw)) == {14: ("half", 1, 2)}
    fact = spark.read.parquet(f"{raw}/measurements")
    rows = {r.sensor_id: r.n for r in fact.groupBy("sensor_id").agg(
        F.count("*").alias("n")).collect()}
    assert rows == {11: 3, 13: 3, 14: 2, 15: 3, 16: 2}  # 12 and 17 have none


def test_ledger_is_right_where_the_fact_alone_is_not(spark, scratch):
    """By readings alone, empty sensors stay pending and half-loaded ones don't."""
    from cityair.operators import merge
    raw = f"{scratch}/raw"
    write_pages(f"{scratch}/pages", "a", FIRST)
    flow.stream_day_pages(spark, f"{scratch}/pages", raw, f"{scratch}/ckpt", 2)
    ask = candidates(spark, 11, 12, 13, 14, 15, 16)
    fact = spark.read.parquet(f"{raw}/measurements")
    assert {r.sensor_id for r in merge.pending(ask, fact).collect()} == {12}
    assert set(states(flow.pending_sensors(spark, ask, raw))) == {13, 14, 15}


def batch_of(spark, pages):
    rows = spark.sparkContext.parallelize([json.dumps(p) for p in pages])
    return spark.read.schema(schemas.DAY_PAGE).json(rows)


def test_replayed_load_counts_once(spark, scratch):
    fact, log = f"{scratch}/fact", f"{scratch}/log"
    batch = batch_of(spark, FIRST)
    for _ in range(2):
        ledger.load_pages(batch, fact, log, "q-0", 2)
    assert ledger.read(spark, log).count() == len(FIRST)
    again = batch_of(spark, [page(11, 1, [1, 2], ts="2024-03-01T00:00:00Z")])
    ledger.load_pages(again, fact, log, "q-1", 2)  # fetched again later
    assert ledger.read(spark, log).count() == len(FIRST)
    assert {r.sensor_id for r in ledger.progress(ledger.read(spark, log)).where(
        "finished").collect()} == {11, 12, 16}


def test_latest_entry_counts_and_a_success_beats_a_failure(spark, scratch):
    for i, p in enumerate([page(1, 1, [1]), page(1, 1, None, "504"),
                           page(2, 1, [1]), page(2, 1, None, "504", "2024-03-01T00:00:00Z"),
                           page(3, 1, [1, 2]), page(3, 2, [3]),
                           page(3, 3, [4], ts="2023-01-01T00:00:00Z")]):
        ledger.append(ledger.entries(batch_of(spark, [p]), 2), scratch, f"l-{i}")
    got = {r.sensor_id: (r.finished, r.last_page, r.rows_loaded) for r in ledger.progress(
        ledger.read(spark, scratch)).collect()}
    assert got == {1: (True, 1, 1), 2: (False, None, 0), 3: (True, 2, 3)}


def test_pending_reads_the_ledger_only(spark, scratch):
    raw = f"{scratch}/raw"
    write_pages(f"{scratch}/pages", "a", FIRST)
    flow.stream_day_pages(spark, f"{scratch}/pages", raw, f"{scratch}/ckpt", 2)
    plan = flow.pending_sensors(spark, candidates(spark, 1), raw)._jdf.queryExecution()
    assert "measurements" not in plan.optimizedPlan().toString()


@pytest.mark.parametrize("bad", [{"sensor_id": 1, "page": 1}, {"sensor_id": 1, "page": 1,
                                                              "results": None}])
def test_pages_without_results_are_failures(spark, bad):
    assert ledger.entries(batch_of(spark, [bad]), 2).first().state == ledger.FAILED
