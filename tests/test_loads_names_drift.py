"""Load verification from the write job, names in the catalog, payload drift."""

import json

import pytest
from pyspark.sql import functions as F

from cityair import flow, schemas
from cityair.operators import quality
from cityair.plans import incremental
from cityair.sources import drift, loads, namespaces, payloads, seeds, sinks, standins as S
from conftest import SF0001

TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    land = str(tmp_path_factory.mktemp("run"))
    S.country_payloads(spark, SF0001).write.json(land + "/countries")
    S.location_payloads(spark, SF0001, False).write.json(land + "/locations")
    S.day_envelopes(spark, SF0001).write.options(**TS).json(land + "/days")
    return land


def ingest(spark, land, raw, run_ts=S.RUN_TS):
    return flow.ingest(spark, land + "/countries", land + "/locations", land + "/days", raw,
                       run_ts, S.AS_OF)


def test_load_log_equals_a_recount(spark, landed, scratch):
    raw = ingest(spark, landed, scratch)
    got = {r.table_name: r for r in flow.load_log(spark, scratch).collect()}
    assert set(got) == set(raw) and str(got["sensors"].run_ts)[:10] == S.RUN_TS[:10]
    for name, df in raw.items():
        assert got[name].rows == df.count()
        for c, n in got[name].nulls.items():
            assert n == df.where(F.col(c).isNull()).count()
    assert got["measurements"].nulls["value_avg"] > 0
    ingest(spark, landed, scratch, "2024-02-01 00:00:00")
    assert flow.load_log(spark, scratch).count() == 2 * len(raw)
    shares = {(r.table_name, r.column_name): r.null_share for r in loads.null_shares(
        flow.load_log(spark, scratch)).collect()}
    assert 0 < shares["measurements", "value_avg"] < 1
    assert shares["measurements", "sensor_id"] == 0


def test_figures_come_from_the_write_itself(spark, scratch):
    """Rows are counted by the job that writes, once, whatever it writes through."""
    reads = spark.sparkContext.accumulator(0)
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("x"))
    counted = df.rdd.map(lambda r: (reads.add(1), r)[1]).toDF(df.schema)
    got = loads.write_observed(counted, lambda d: sinks.write_table(d, scratch + "/t"), ("x",))
    assert got == {"rows": 1000, "nulls": {"x": 250}} and reads.value == 1000
    empty = loads.write_observed(df.limit(0), lambda d: sinks.write_table(d, scratch + "/e"),
                                 ("x",))
    assert empty == {"rows": 0, "nulls": {"x": 0}}


def test_models_are_read_by_name_from_another_session(spark, landed, scratch):
    raw = ingest(spark, landed, f"{scratch}/raw")
    table = f"{scratch}/city_daily"
    flow.build_incremental(spark, raw, table)
    names = flow.publish(spark, f"{scratch}/raw", table, f"{scratch}/schemas")
    want = flow.build(spark, raw).as_dict()
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    assert not [t for t in other.catalog.listTables() if not t.isTemporary]
    for name in names:
        got, model = other.table(name), want[name.split(".")[1]]
        columns = [c for c in model.columns]
        assert set(columns) <= set(got.columns) <= {*columns, "month"}
        cut = lambda df: sorted(str([round(x, 9) if isinstance(x, float) else x
                                     for x in r]) for r in df.select(*columns).collect())
        assert cut(got) == cut(model), name
    worst = other.sql("SELECT city FROM analytics.city_pollution_ranking "
                      "WHERE parameter = 'pm25' AND pollution_rank = 1").collect()
    assert worst
    models = {n.split(".")[1]: other.table(n) for n in names}
    assert all(r.passed for r in quality.run_suite(models, quality.reference_checks()).collect())


def test_names_follow_a_load(spark, landed, scratch):
    raw = ingest(spark, landed, f"{scratch}/raw")
    table = f"{scratch}/city_daily"
    flow.build_incremental(spark, raw, table)
    namespaces.create(spark, f"{scratch}/schemas", "raw_b", "analytics_b")
    names = lambda: (namespaces.publish_raw(spark, f"{scratch}/raw", "raw_b"),
                     namespaces.publish_models(spark, table, "raw_b", "analytics_b"))
    names()
    before = spark.table("raw_b.measurements_daily").count()
    late = raw["measurements"].limit(1).drop("month").select(
        *[F.lit("2031-05-01").cast("timestamp").alias(c) if c == "date_utc" else F.col(c)
          for c in schemas.MEASUREMENTS_DAILY.fieldNames()])
    late = sinks.materialize(late, "late")
    from cityair.operators.merge import month_of
    sinks.upsert_partitions(late, f"{scratch}/raw/measurements", ["sensor_id", "date_utc"],
                            "month", month_of("date_utc"))
    state = flow.read_raw(spark, f"{scratch}/raw")
    incremental.refresh(incremental.touched_by_readings(late, state["sensors"],
                                                        state["locations"]),
                        state["measurements"], state["sensors"], state["locations"],
                        seeds.molecular_weights(spark), table)
    names()
    assert spark.newSession().table("raw_b.measurements_daily").count() == before + 1
    # Staging pushes its filters through the view to the fact's scan.
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = spark.sql("SELECT measurement_id FROM analytics_b.stg_air_quality WHERE parameter = "
                     "'pm25'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(percent_complete,75.0)" in plan


# ---- drift ----

LINES = [
    {"id": 1, "name": "a", "sensors": [{"id": 1, "parameter": {"id": "x"}}], "extra": {"a": 1.5}},
    {"id": "s", "country": None, "coordinates": {"latitude": 1, "longitude": 2.5}},
    {"id": 2, "sensors": [], "tags": ["p", "q"], "isMobile": "no", "timezone": {"name": "UTC"}},
    '{"id":', [1], "null", {},
]


def lines(spark, rows=LINES):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows]
                                 + [(None,)], "value string")


def test_drift_names_added_and_retyped_fields(spark):
    got = {(r.path, r.found): (r.records, r.expected, r.status) for r in drift.drift_report(
        lines(spark), schemas.LOCATION_PAYLOAD).collect()}
    assert got == {
        ("", "MALFORMED"): (1, "OBJECT", "malformed"), ("", "ARRAY"): (1, "OBJECT", "retyped"),
        ("[]", "INTEGER"): (1, None, "added"),
        ("id", "STRING"): (1, "INTEGER", "retyped"),
        ("sensors[].parameter.id", "STRING"): (1, "INTEGER", "retyped"),
        ("extra", "OBJECT"): (1, None, "added"), ("extra.a", "NUMBER"): (1, None, "added"),
        ("tags", "ARRAY"): (1, None, "added"), ("tags[]", "STRING"): (2, None, "added"),
        ("isMobile", "STRING"): (1, "BOOLEAN", "retyped"),
        ("timezone", "OBJECT"): (1, "STRING", "retyped"),
        ("timezone.name", "STRING"): (1, None, "added")}


def brute(rows):
    from collections import Counter
    out = Counter()

    def visit(path, v):
        kind = ("NULL" if v is None else "BOOLEAN" if isinstance(v, bool)
                else "INTEGER" if isinstance(v, int) else "NUMBER" if isinstance(v, float)
                else "STRING" if isinstance(v, str) else "ARRAY" if isinstance(v, list)
                else "OBJECT")
        out[path, kind] += 1
        for k, x in (v.items() if kind == "OBJECT" else [(None, x) for x in v]
                     if kind == "ARRAY" else ()):
            visit(f"{path}[]" if k is None else f"{path}.{k}" if path else k, x)
    for r in rows:
        if isinstance(r, str):
            try:
                r = json.loads(r)
            except ValueError:
                out["", "MALFORMED"] += 1
                continue
        visit("", r)
    return dict(out)


def test_field_counts_equal_a_plain_walk(spark):
    got = {(r.path, r.found): r.records for r in drift.field_counts(lines(spark)).collect()}
    assert got == brute(LINES)


def test_typed_columns_do_not_change_with_drift(spark, scratch):
    """A source that only adds fields reads as before; the report names them."""
    text = S.location_payloads(spark, SF0001, False).select(
        F.to_json(F.struct("*")).alias("value"))
    more = text.select(F.replace("value", F.lit('{"id"'), F.lit('{"added":1,"id"')).alias("value"))
    text.write.text(f"{scratch}/a")
    more.write.text(f"{scratch}/b")
    a, none = drift.read_with_drift(spark, f"{scratch}/a", schemas.LOCATION_PAYLOAD)
    b, report = drift.read_with_drift(spark, f"{scratch}/b", schemas.LOCATION_PAYLOAD)
    flat = lambda df: sorted(map(str, payloads.flatten_locations(df, S.RUN_TS).collect()))
    assert flat(a) == flat(b) and none.count() == 0
    assert {r.path for r in report.collect()} == {
        "added", "country.added", "provider.added", "sensors[].added",
        "sensors[].parameter.added"}


def test_drift_of_nothing(spark):
    empty = spark.createDataFrame([], "value string")
    assert drift.drift_report(empty, schemas.DAY_ENVELOPE).collect() == []
    assert drift.expected_types(schemas.DAY_ENVELOPE)["reading.period.datetimeFrom.utc"] == "STRING"
    assert drift.expected_types(schemas.DAY_ENVELOPE)["ingested_at"] == "STRING"
