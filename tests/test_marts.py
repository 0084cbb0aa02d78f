"""Ranking, alerts, KPIs and serving datasets on hand-written rows."""

import datetime as dt


from cityair import schemas
from cityair.plans import marts, serving

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def cda(spark, rows):
    return spark.createDataFrame(rows, schemas.CITY_DAILY_AVG)


def test_null_average_ranks_first_and_ties_share_rank(spark):
    df = cda(spark, [("A", "X", "pm25", D1, None, None, 1),
                     ("B", "X", "pm25", D1, 30.0, 31.0, 1),
                     ("C", "X", "pm25", D1, 30.0, 32.0, 1),
                     ("D", "X", "pm25", D1, 10.0, 11.0, 1)])
    ranks = {r.city: r.pollution_rank for r in marts.pollution_ranking(df).collect()}
    assert ranks == {"A": 1, "B": 2, "C": 2, "D": 4}


def test_ranking_is_average_of_daily_averages(spark):
    df = cda(spark, [("A", "X", "pm25", D1, 10.0, 12.0, 100), ("A", "X", "pm25", D2, 20.0, 25.0, 1)])
    r = marts.pollution_ranking(df).first()
    assert r.overall_avg_value == 15.0 and r.overall_max_value == 25.0


def test_alert_threshold_is_strict(spark):
    df = cda(spark, [("A", "X", "pm25", D1, 25.0, 25.0, 1), ("B", "X", "pm25", D1, 25.01, 26.0, 1),
                     ("C", "X", "no2", D1, 99.0, 99.0, 1)])
    assert [r.city for r in marts.pm25_alerts(df).collect()] == ["B"]


def test_kpi(spark):
    df = cda(spark, [("A", "X", "pm25", D1, 1.0, 1.0, 3), ("A", "Y", "no2", D2, 1.0, 1.0, 4)])
    r = marts.kpi_summary(df).first()
    assert (r.cities_monitored, r.total_readings, r.earliest_date, r.latest_date) == (1, 7, D1, D2)


def test_half_even_label_and_zero_cap(spark):
    m = spark.createDataFrame(
        [("pm25", "2024-01", "A", "X", 0.0, 0.0, 0.25), ("pm25", "2024-01", "B", "X", 0.0, 0.0, 0.75),
         ("pm25", "2024-01", "C", "X", 0.0, 0.0, 0.0)],
        "parameter string, ym string, city string, country string, lat double, lon double, "
        "avg_value double")
    caps = spark.createDataFrame([("pm25", 0.0, 0.0)], "parameter string, cmax double, xmax double")
    rows = {r.city: r for r in serving.map_frames(m, caps).collect()}
    assert rows["A"].label_value == 0.2 and rows["B"].label_value == 0.8
    assert rows["A"].marker_size is None  # cmax = 0: no division error


def test_monthly_top_keeps_n_per_month(spark):
    rows = [("pm25", "2024-01", f"C{i}", "X", 0.0, 0.0, float(i)) for i in range(20)]
    rows += [("pm25", "2024-02", "C0", "X", 0.0, 0.0, 1.0)]
    m = spark.createDataFrame(rows, "parameter string, ym string, city string, country string, "
                                    "lat double, lon double, avg_value double")
    top = serving.monthly_top(m, 15).collect()
    jan = [r for r in top if r.ym == "2024-01"]
    assert len(jan) == 15 and min(r.avg_value for r in jan) == 5.0
    assert len([r for r in top if r.ym == "2024-02"]) == 1


def test_quantiles_interpolate(spark):
    m = spark.createDataFrame([("pm25", float(v)) for v in range(1, 11)],
                              "parameter string, avg_value double")
    r = serving.colour_caps(m).first()
    assert abs(r.cmax - 9.55) < 1e-9  # linear interpolation, like pandas
    assert abs(r.xmax - 9.82 * 1.05) < 1e-9


def test_alert_filters_optional(spark):
    a = spark.createDataFrame([("A", "X", D1, 30.0), ("B", "Y", D2, 40.0)],
                              "city string, country string, reading_date date, pm25_avg_value double")
    assert serving.alerts_filtered(a).count() == 2
    assert serving.alerts_filtered(a, ["X"]).count() == 1
    assert serving.alerts_filtered(a, [], "2024-01-15", None).count() == 2  # one end only: ignored
    assert serving.alerts_filtered(a, [], "2024-01-15", "2024-02-01").count() == 1
    r = serving.alerts_shown(a, ["Y"]).first()
    assert (r.shown, r.total) == (1, 2)


def test_city_trend_binds_parameters(spark):
    df = cda(spark, [("O'Hare", "X", "pm25", D2, 2.0, 2.0, 1), ("O'Hare", "X", "pm25", D1, 1.0, 1.0, 1)])
    rows = serving.city_trend(spark, df, "O'Hare", "pm25").collect()
    assert [r.avg_value for r in rows] == [1.0, 2.0]


def _monthly(spark, rows):
    return spark.createDataFrame(rows, "parameter string, ym string, city string, country string, "
                                       "lat double, lon double, avg_value double")


def test_per_pollutant_latest_month_and_caps(spark):
    m = _monthly(spark, [("pm25", "2024-01", "A", "X", 0.0, 0.0, 10.0),
                         ("pm25", "2024-02", "A", "X", 0.0, 0.0, 20.0),
                         ("no2", "2023-12", "A", "X", 0.0, 0.0, 100.0),
                         ("no2", "2023-11", "B", "X", 0.0, 0.0, 300.0)])
    latest = {(r.parameter, r.ym) for r in serving.latest_month(m).collect()}
    assert latest == {("pm25", "2024-02"), ("no2", "2023-12")}
    caps = {r.parameter: r.cmax for r in serving.colour_caps(m).collect()}
    assert abs(caps["pm25"] - 19.5) < 1e-9 and abs(caps["no2"] - 290.0) < 1e-9
    frames = {(r.parameter, r.ym): r.marker_size for r in serving.map_frames(m).collect()}
    assert abs(frames[("no2", "2023-11")] - 30.0) < 1e-9        # clipped at its own cap
    assert frames[("pm25", "2024-01")] < frames[("pm25", "2024-02")] <= 30.0
    top = serving.monthly_top(m, 1).collect()
    assert {(r.parameter, r.ym, r.city) for r in top} == {
        ("pm25", "2024-01", "A"), ("pm25", "2024-02", "A"), ("no2", "2023-12", "A"),
        ("no2", "2023-11", "B")}


def test_trend_keeps_both_countries_of_a_city(spark):
    """The trend filters on city and pollutant only: a city spread over two
    countries gives two rows per date, ordered by date then country."""
    df = cda(spark, [("Rome", "Vatican", "pm25", D1, 2.0, 2.0, 1),
                     ("Rome", "Italy", "pm25", D1, 1.0, 1.0, 1),
                     ("Rome", "Italy", "pm25", D2, 3.0, 3.0, 1)])
    rows = serving.city_trend(spark, df, "Rome", "pm25").collect()
    assert [(r.reading_date, r.avg_value) for r in rows] == [(D1, 1.0), (D1, 2.0), (D2, 3.0)]
