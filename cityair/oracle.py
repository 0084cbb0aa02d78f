"""DuckDB SQL for every registered query, written independently of the
Spark plans: the stand-in rules of FIXTURES.md restated as SQL, then each
model as plain SQL. Doubles are rounded to four decimals, like the Spark
side; DuckDB-specific casts keep result types equal to Spark's.
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name, sql, deps=()):
    CTES[name] = (sql, tuple(deps))


cte("ev", """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                       WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS code
FROM events""")

cte("ev2", f"""
SELECT *, CASE WHEN k = 7 THEN CAST(NULL AS DOUBLE) WHEN k = 11 THEN {D('10000')}
               WHEN k = 13 THEN -value ELSE value END AS v,
       CAST(100 - k * 0.5 AS DOUBLE) AS pct,
       date_trunc('day', ts) AS day
FROM ev""", ["ev"])

cte("readings", f"""
SELECT CAST(user_id * 10 + code AS BIGINT) AS sensor_id,
       day AS date_utc,
       strftime(day, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS date_local,
       day + INTERVAL 1 DAY AS datetime_to_utc,
       v AS value_avg, v * {D('0.5')} AS value_min, v * {D('1.5')} AS value_max,
       v AS value_median, abs(v * {D('0.1')}) AS value_sd,
       CAST(code AS BIGINT) AS parameter_id,
       CASE event_type WHEN 'click' THEN 'PM25'
            WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'no2' ELSE 'so2' END
            WHEN 'purchase' THEN 'o3' WHEN 'signup' THEN 'co'
            WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'pm10' ELSE 'temperature' END
       END AS parameter_name,
       CASE WHEN event_type IN ('click', 'view') THEN 'µg/m³'
            WHEN user_id % 3 = 0 THEN 'ppm' WHEN user_id % 3 = 1 THEN 'PPB'
            ELSE 'µg/m³' END AS parameter_units,
       CAST(24 AS BIGINT) AS expected_count,
       CAST(floor(pct * 24 / 100) AS BIGINT) AS observed_count,
       pct AS percent_complete,
       '1day' AS period_label,
       ts AS ingested_at
FROM ev2""", ["ev2"])

cte("meas", """
SELECT * FROM readings
QUALIFY row_number() OVER (PARTITION BY sensor_id, date_utc ORDER BY ingested_at DESC) = 1""",
    ["readings"])

cte("sens", """
SELECT CAST(c_custkey * 10 + code AS BIGINT) AS sensor_id, c_custkey AS location_id
FROM (SELECT c_custkey, unnest(range(1, 6)) AS code FROM customer)""")

cte("nr", """
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")

cte("stations", f"""
SELECT c_custkey AS location_id, c_name AS name, n_name AS locality,
       CAST(CASE WHEN c_custkey % 25 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS BIGINT)
         AS country_id,
       'N' || CAST(CASE WHEN c_custkey % 25 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END
                   AS VARCHAR) AS country_code,
       r_name AS country_name,
       n_name AS home_capital, 'N' || CAST(c_nationkey AS VARCHAR) AS home_cca2,
       (c_nationkey % 5) * {D('0.5')} + (c_custkey % 9 - 4) * {D('0.08')} AS latitude,
       floor(c_nationkey / 5) * {D('0.5')} + (c_custkey % 7 - 3) * {D('0.08')} AS longitude,
       'UTC' AS timezone, c_custkey % 7 AS provider_id,
       'provider-' || CAST(c_custkey % 7 AS VARCHAR) AS provider_name,
       c_custkey % 10 = 0 AS is_mobile, c_custkey % 10 <> 0 AS is_monitor,
       CAST(DATE '2020-01-01' - CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS datetime_first_utc,
       CAST(DATE '2024-01-30' - CAST(c_custkey % 60 AS INTEGER) AS TIMESTAMP) AS datetime_last_utc,
       TIMESTAMP '2024-01-31 00:00:00' AS ingested_at,
       CAST(c_custkey % 4 AS INTEGER) AS sensor_count
FROM customer JOIN nr ON c_nationkey = n_nationkey""", ["nr"])

cte("locs", """
SELECT location_id, name, locality, country_id, country_code, country_name,
       home_capital AS capital_country, home_capital AS capital_name, home_cca2 AS capital_cca2,
       latitude, longitude, timezone, provider_id, provider_name, is_mobile, is_monitor,
       datetime_first_utc, datetime_last_utc, ingested_at
FROM stations""", ["stations"])

cte("mw", f"""
SELECT * FROM (VALUES ('no2', {D('46.0055')}), ('o3', {D('48.0')}), ('so2', {D('64.066')}),
                      ('co', {D('28.01')}), ('pm25', CAST(NULL AS DOUBLE)),
                      ('pm10', CAST(NULL AS DOUBLE))) t(parameter, w)""")

cte("joined", """
SELECT m.sensor_id, m.date_utc, m.value_avg, m.value_max,
       lower(m.parameter_name) AS parameter, lower(m.parameter_units) AS unit,
       m.percent_complete, l.location_id, l.capital_name AS city, l.country_name AS country,
       l.capital_cca2, mw.w
FROM meas m
JOIN sens s ON m.sensor_id = s.sensor_id
JOIN locs l ON s.location_id = l.location_id
LEFT JOIN mw ON lower(m.parameter_name) = mw.parameter
WHERE m.value_avg IS NOT NULL""", ["meas", "sens", "locs", "mw"])


def conv(v):
    return (f"CASE WHEN unit = 'ppm' THEN {v} * w * {D('1000')} / {D('24.45')} "
            f"WHEN unit = 'ppb' THEN {v} * w / {D('24.45')} ELSE {v} END")


MID = ("md5(CAST(sensor_id AS VARCHAR) || '-' || "
       "strftime(date_utc, '%Y-%m-%d %H:%M:%S') || '+00')")

CLEAN = """
  value_avg >= 0 AND value_avg < 10000 AND percent_complete >= 75
  AND parameter IN ('pm25', 'pm10', 'no2', 'co', 'o3', 'so2') AND city IS NOT NULL
  AND NOT (unit = 'ppm' AND value_avg > 50) AND NOT (unit = 'ppb' AND value_avg > 50000)"""

cte("stg_full", f"""
SELECT {MID} AS measurement_id, city, country, parameter,
       {conv('value_avg')} AS value, {conv('value_max')} AS max_value,
       'ug/m3' AS unit, date_utc, percent_complete, location_id, capital_cca2
FROM joined WHERE {CLEAN}""", ["joined"])

cte("stg", """
SELECT measurement_id, city, country, parameter, value, max_value, unit, date_utc,
       percent_complete FROM stg_full""", ["stg_full"])

cte("cda", """
SELECT city, country, parameter, CAST(date_utc AS DATE) AS reading_date,
       avg(value) AS avg_value, max(max_value) AS max_value, count(*) AS num_readings
FROM stg GROUP BY city, country, parameter, CAST(date_utc AS DATE)""", ["stg"])

cte("ranking", """
SELECT city, country, parameter, avg(avg_value) AS overall_avg_value,
       max(max_value) AS overall_max_value,
       CAST(rank() OVER (PARTITION BY parameter ORDER BY avg(avg_value) DESC NULLS FIRST)
            AS INTEGER) AS pollution_rank
FROM cda GROUP BY city, country, parameter""", ["cda"])

cte("alerts", """
SELECT city, country, reading_date, avg_value AS pm25_avg_value
FROM cda WHERE parameter = 'pm25' AND avg_value > 25""", ["cda"])

cte("kpi", """
SELECT count(DISTINCT city) AS cities_monitored,
       CAST(sum(num_readings) AS BIGINT) AS total_readings,
       min(reading_date) AS earliest_date, max(reading_date) AS latest_date
FROM cda""", ["cda"])

cte("countries", f"""
SELECT n_name AS country_name, 'N' || CAST(n_nationkey AS VARCHAR) AS alpha_2,
       'NAT' || CAST(n_nationkey AS VARCHAR) AS alpha_3, r_name AS region,
       r_name || CASE WHEN n_nationkey % 2 = 0 THEN ' west' ELSE ' east' END AS subregion,
       CAST(n_nationkey AS BIGINT) * 1000000 + 12345 AS population,
       n_nationkey * {D('1000.5')} AS area_sq_km,
       n_name AS capital_name,
       (n_nationkey % 5) * {D('0.5')} AS capital_lat,
       floor(n_nationkey / 5) * {D('0.5')} AS capital_lon,
       TIMESTAMP '2024-01-31 00:00:00' AS ingested_at
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'Farland', 'ZZ', 'ZZZ', 'NOWHERE', 'NOWHERE', CAST(1 AS BIGINT), {D('1.0')},
       'Farpoint', {D('80.0')}, {D('80.0')}, TIMESTAMP '2024-01-31 00:00:00'""")

cte("capitals", """
SELECT country_name AS country, alpha_2 AS cca2, capital_name AS capital,
       capital_lat AS lat, capital_lon AS lon
FROM countries WHERE alpha_2 IS NOT NULL AND alpha_2 <> '' AND capital_lat IS NOT NULL""",
    ["countries"])

cte("pairs", f"""
SELECT s.*, c.country AS capital_country, c.capital AS capital_name, c.cca2 AS capital_cca2,
       c.lat AS capital_lat, c.lon AS capital_lon
FROM stations s JOIN capitals c
  ON s.latitude BETWEEN c.lat - {D('0.3')} AND c.lat + {D('0.3')}
 AND s.longitude BETWEEN c.lon - {D('0.3')} AND c.lon + {D('0.3')}""",
    ["stations", "capitals"])

ACTIVE = "datetime_last_utc >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 30 DAY"

cte("survey", f"""
SELECT c.country, c.cca2, c.capital,
       CAST(coalesce(p.total_locations, 0) AS BIGINT) AS total_locations,
       CAST(coalesce(p.active_locations, 0) AS BIGINT) AS active_locations,
       p.earliest_data, p.latest_data,
       CAST(coalesce(p.sensors_total, 0) AS BIGINT) AS sensors_total,
       CAST(NULL AS VARCHAR) AS error
FROM capitals c LEFT JOIN (
  SELECT capital_cca2 AS cca2, count(*) AS total_locations,
         count(*) FILTER (WHERE {ACTIVE}) AS active_locations,
         CAST(min(datetime_first_utc) AS DATE) AS earliest_data,
         CAST(max(datetime_last_utc) AS DATE) AS latest_data,
         sum(sensor_count) AS sensors_total
  FROM pairs GROUP BY capital_cca2) p ON c.cca2 = p.cca2""", ["capitals", "pairs"])

cte("survey_errors", f"""
SELECT s.country, s.cca2, s.capital,
       CASE WHEN e.error IS NULL THEN s.total_locations END AS total_locations,
       CASE WHEN e.error IS NULL THEN s.active_locations END AS active_locations,
       CASE WHEN e.error IS NULL THEN s.earliest_data END AS earliest_data,
       CASE WHEN e.error IS NULL THEN s.latest_data END AS latest_data,
       CASE WHEN e.error IS NULL THEN s.sensors_total END AS sensors_total, e.error
FROM survey s LEFT JOIN (
  SELECT capital_cca2 AS cca2,
         CASE WHEN any_value(no) % 11 = 7 THEN '503 Server Error for ' || capital_cca2
              ELSE min('malformed record: {{"id":' || location_id || ',"name":"' || name || '"')
                     FILTER (WHERE location_id % 40 = 0)
                   || CASE WHEN count(*) FILTER (WHERE location_id % 40 = 0) > 1
                      THEN ' (and ' || (count(*) FILTER (WHERE location_id % 40 = 0) - 1)
                           || ' more)' ELSE '' END END AS error
  FROM (SELECT *, CAST(nullif(substring(capital_cca2, 2), 'Z') AS INTEGER) AS no FROM pairs)
  WHERE no % 11 = 7 OR no % 9 = 4 GROUP BY capital_cca2) e ON s.cca2 = e.cca2""",
    ["survey", "pairs"])

cte("ledger", """
SELECT sensor_id, location_id, n, n // 8 AS pages_loaded, n // 8 * 8 AS rows_loaded
FROM (SELECT CAST(c_custkey * 10 + i AS BIGINT) AS sensor_id, c_custkey AS location_id
      FROM (SELECT c_custkey, unnest(range(1, CAST(c_custkey % 4 AS INTEGER) + 1)) AS i
            FROM customer)) s
LEFT JOIN (SELECT sensor_id AS id, count(*) AS n FROM meas GROUP BY sensor_id)
  ON id = sensor_id""", ["meas"])

cte("drifting", """
SELECT c_custkey AS n FROM customer JOIN nr ON c_nationkey = n_nationkey""", ["nr"])

cte("coords", """
SELECT capital_name AS city, avg(latitude) AS lat, avg(longitude) AS lon
FROM locs GROUP BY capital_name""", ["locs"])

cte("order_daily", """
SELECT n_name AS city, r_name AS country, 'pm25' AS parameter,
       CAST(o_orderdate AS DATE) AS reading_date, o_totalprice AS avg_value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nr ON c_nationkey = n_nationkey""",
    ["nr"])

cte("monthly", """
SELECT m.parameter, m.city, m.country, m.ym, m.avg_value, c.lat, c.lon
FROM (SELECT parameter, city, country,
             strftime(date_trunc('month', reading_date), '%Y-%m') AS ym,
             avg(avg_value) AS avg_value
      FROM order_daily WHERE parameter = 'pm25'
      GROUP BY parameter, city, country, strftime(date_trunc('month', reading_date), '%Y-%m')) m
JOIN coords c ON m.city = c.city""", ["order_daily", "coords"])

cte("caps", f"""
SELECT parameter, quantile_cont(avg_value, 0.95) AS cmax,
       quantile_cont(avg_value, 0.98) * {D('1.05')} AS xmax
FROM monthly GROUP BY parameter""", ["monthly"])

cte("alltime", """
SELECT r.city, r.country, r.parameter, r.overall_avg_value AS avg_value, c.lat, c.lon
FROM ranking r JOIN coords c ON r.city = c.city WHERE r.parameter = 'pm25'""",
    ["ranking", "coords"])

cte("converted", f"""
SELECT sensor_id, date_utc, parameter, unit, value_avg,
       {conv('value_avg')} AS value, {conv('value_max')} AS max_value
FROM joined""", ["joined"])

cte("tagged", f"""
SELECT * FROM pairs WHERE {ACTIVE}
QUALIFY row_number() OVER (
  PARTITION BY location_id
  ORDER BY ingested_at DESC,
           (latitude - capital_lat) ** 2 + (longitude - capital_lon) ** 2,
           capital_cca2) = 1""", ["pairs"])


def _resolve(names):
    order, seen = [], set()

    def visit(n):
        if n in seen:
            return
        seen.add(n)
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def sql(final: str, *uses: str) -> str:
    names = _resolve(uses)
    if not names:
        return final.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in names)
    return f"WITH {body}\n{final.strip()}"





def rnd(expr):
    """Four decimals after a 9-decimal DECIMAL snap (same rule as the Spark side)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), 4) AS DOUBLE)"


def R(c):
    return f"{rnd(c)} AS {c}"


def label(expr):
    """pandas-style half-even rounding to one decimal."""
    return f"round_even(round({expr}, 9) * 10, 0) / 10"

PAIR_COLS = ("location_id, capital_cca2, capital_name, capital_country, country_code, "
             f"{rnd('latitude')} AS latitude, {rnd('longitude')} AS longitude")

ORACLE = {
    "stg_air_quality": sql(f"""
        SELECT measurement_id, city, country, parameter, {R('value')}, {R('max_value')}, unit,
               date_utc, {R('percent_complete')} FROM stg""", "stg"),
    "city_daily_avg": sql(f"""
        SELECT city, country, parameter, reading_date, {R('avg_value')}, {R('max_value')},
               num_readings FROM cda""", "cda"),
    "pollution_ranking": sql(f"""
        SELECT city, country, parameter, {R('overall_avg_value')}, {R('overall_max_value')},
               pollution_rank FROM ranking""", "ranking"),
    "pollution_ranking_ranges": sql(f"""
        SELECT city, country, parameter, {R('overall_avg_value')}, {R('overall_max_value')},
               pollution_rank FROM ranking""", "ranking"),
    "city_daily_incremental": sql(f"""
        SELECT city, country, parameter, reading_date, {R('avg_value')}, {R('max_value')},
               num_readings FROM cda""", "cda"),
    "top10_pm25": sql(f"""
        SELECT city, {R('overall_avg_value')}, pollution_rank FROM ranking
        WHERE parameter = 'pm25' ORDER BY pollution_rank, city, country LIMIT 10""", "ranking"),
    "kpi_summary": sql("SELECT * FROM kpi", "kpi"),
    "pm25_alerts": sql(f"""
        SELECT city, country, reading_date, {R('pm25_avg_value')} FROM alerts
        ORDER BY pm25_avg_value DESC""", "alerts"),
    "surrogate_key": sql(f"SELECT sensor_id, date_utc, {MID} AS measurement_id FROM meas",
                         "meas"),
    "unit_convert": sql(f"""
        SELECT sensor_id, date_utc, parameter, unit, {R('value_avg')}, {R('value')},
               {R('max_value')} FROM converted""", "converted"),
    "unit_caps": sql(f"""
        SELECT sensor_id, date_utc, lower(parameter_units) AS unit, {R('value_avg')},
               NOT (lower(parameter_units) = 'ppm' AND value_avg > 50)
               AND NOT (lower(parameter_units) = 'ppb' AND value_avg > 50000) AS passes_caps
        FROM meas WHERE value_avg IS NOT NULL""", "meas"),
    "merge_upsert": sql(f"""
        SELECT sensor_id, date_utc, date_local, datetime_to_utc, {R('value_avg')},
               {R('value_min')}, {R('value_max')}, {R('value_median')}, {R('value_sd')},
               parameter_id, parameter_name, parameter_units, expected_count, observed_count,
               {R('percent_complete')}, period_label, ingested_at FROM meas""", "meas"),
    "flatten_measurements": sql(f"""
        SELECT sensor_id, date_utc, date_local, datetime_to_utc, {R('value_avg')},
               {R('value_min')}, {R('value_max')}, {R('value_median')}, {R('value_sd')},
               parameter_id, parameter_name, parameter_units, expected_count, observed_count,
               {R('percent_complete')}, period_label, ingested_at FROM readings""", "readings"),
    "flatten_countries": sql(f"""
        SELECT country_name, alpha_2, alpha_3, region, subregion, population,
               {R('area_sq_km')}, capital_name, {R('capital_lat')}, {R('capital_lon')},
               ingested_at FROM countries""", "countries"),
    "flatten_locations": sql(f"""
        SELECT location_id, name, locality, country_id, country_code, country_name,
               capital_country, capital_name, capital_cca2, {R('latitude')}, {R('longitude')},
               timezone, provider_id, provider_name, is_mobile, is_monitor,
               datetime_first_utc, datetime_last_utc, ingested_at FROM locs""", "locs"),
    "explode_sensors": sql("""
        SELECT CAST(c_custkey * 10 + i AS BIGINT) AS sensor_id, c_custkey AS location_id,
               'sensor-' || CAST(c_custkey * 10 + i AS VARCHAR) AS sensor_name,
               CAST(i AS BIGINT) AS parameter_id,
               ['pm25', 'no2', 'o3'][i] AS parameter_name,
               ['µg/m³', 'ppb', 'ppm'][i] AS parameter_units,
               upper(['pm25', 'no2', 'o3'][i]) AS parameter_display_name,
               TIMESTAMP '2024-01-31 00:00:00' AS ingested_at
        FROM (SELECT c_custkey, unnest(range(1, CAST(c_custkey % 4 AS INTEGER) + 1)) AS i
              FROM customer)"""),
    "row_counts": sql("""
        SELECT 'countries' AS table_name, count(*) AS rows FROM countries
        UNION ALL SELECT 'locations', count(*) FROM locs
        UNION ALL SELECT 'sensors', count(*) FROM sens
        UNION ALL SELECT 'measurements_daily', count(*) FROM meas""",
                      "countries", "locs", "sens", "meas"),
    "load_metrics": sql("""
        SELECT table_name, column_name, rows, nulls,
               CAST(round(nulls / rows, 4) AS DOUBLE) AS null_share
        FROM (SELECT 'countries' AS table_name, 'alpha_2' AS column_name, count(*) AS rows,
                     count(*) - count(alpha_2) AS nulls FROM countries
              UNION ALL SELECT 'countries', 'capital_lat', count(*),
                     count(*) - count(capital_lat) FROM countries
              UNION ALL SELECT 'locations', 'location_id', count(*),
                     count(*) - count(location_id) FROM locs
              UNION ALL SELECT 'locations', 'capital_cca2', count(*),
                     count(*) - count(capital_cca2) FROM locs
              UNION ALL SELECT 'sensors', 'sensor_id', count(*),
                     count(*) - count(sensor_id) FROM sens
              UNION ALL SELECT 'measurements_daily', 'sensor_id', count(*),
                     count(*) - count(sensor_id) FROM meas
              UNION ALL SELECT 'measurements_daily', 'value_avg', count(*),
                     count(*) - count(value_avg) FROM meas)""",
                        "countries", "locs", "sens", "meas"),
    "models_by_name": sql("""
        SELECT 'analytics.stg_air_quality' AS name, count(*) AS rows FROM stg
        UNION ALL SELECT 'analytics.city_daily_avg', count(*) FROM cda
        UNION ALL SELECT 'analytics.city_pollution_ranking', count(*) FROM ranking
        UNION ALL SELECT 'analytics.kpi_summary', count(*) FROM kpi
        UNION ALL SELECT 'analytics.who_pm25_alerts', count(*) FROM alerts
        UNION ALL SELECT 'raw.measurements_daily', count(*) FROM meas
        UNION ALL SELECT 'raw.locations', count(*) FROM locs
        UNION ALL SELECT 'raw.sensors', count(*) FROM sens
        UNION ALL SELECT 'raw.countries', count(*) FROM countries""",
                          "stg", "cda", "ranking", "kpi", "alerts", "meas", "locs", "sens",
                          "countries"),
    "payload_drift": sql("""
        SELECT * FROM (
          SELECT 'elevation' AS path, 'INTEGER' AS found, count(*) AS records,
                 CAST(NULL AS VARCHAR) AS expected, 'added' AS status
          FROM drifting WHERE n % 50 = 0 AND n % 70 <> 0
          UNION ALL SELECT 'sensors[].parameter.unitsCode', 'INTEGER',
                 CAST(coalesce(sum(n % 4), 0) AS BIGINT), NULL, 'added'
          FROM drifting WHERE n % 30 = 0 AND n % 70 <> 0
          UNION ALL SELECT 'provider.id', 'STRING', count(*), 'INTEGER', 'retyped'
          FROM drifting WHERE n % 40 = 0 AND n % 70 <> 0
          UNION ALL SELECT '', 'MALFORMED', count(*), 'OBJECT', 'malformed'
          FROM drifting WHERE n % 70 = 0) WHERE records > 0""", "drifting"),
    "window_days": sql(f"""
        SELECT sensor_id, date_utc, {R('value_avg')} FROM meas
        WHERE date_utc >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY""", "meas"),
    "pending_sensors": sql("""
        SELECT CAST(c_custkey * 10 + i AS BIGINT) AS sensor_id, c_custkey AS location_id
        FROM (SELECT c_custkey, unnest(range(1, CAST(c_custkey % 4 AS INTEGER) + 1)) AS i
              FROM customer)
        WHERE CAST(c_custkey * 10 + i AS BIGINT) NOT IN (SELECT sensor_id FROM meas)""",
                           "meas"),
    "pending_by_ledger": sql("""
        SELECT sensor_id, location_id, CAST(coalesce(pages_loaded, 0) AS BIGINT) AS pages_loaded,
               CAST(coalesce(rows_loaded, 0) AS BIGINT) AS rows_loaded,
               CASE WHEN n IS NULL AND location_id % 3 = 0 THEN 'new' ELSE 'failed' END AS state
        FROM ledger WHERE sensor_id % 7 = 3 OR n IS NULL AND location_id % 3 = 0""", "ledger"),
    "capitals_dim": sql(f"SELECT country, cca2, capital, {R('lat')}, {R('lon')} FROM capitals",
                        "capitals"),
    "capitals_csv": sql(f"SELECT country, cca2, capital, {R('lat')}, {R('lon')} FROM capitals",
                        "capitals"),
    "capitals_filter": sql(f"""
        SELECT country, cca2, capital, {R('lat')}, {R('lon')} FROM capitals
        WHERE cca2 IN ('N1', 'N3', 'N7', 'N12', 'N20') ORDER BY cca2 LIMIT 3""", "capitals"),
    "bbox_match": sql(f"SELECT {PAIR_COLS} FROM pairs", "pairs"),
    "bbox_match_same_country": sql(
        f"SELECT {PAIR_COLS} FROM pairs WHERE country_code IS NOT DISTINCT FROM capital_cca2",
        "pairs"),
    "active_stations": sql(f"SELECT {PAIR_COLS} FROM pairs WHERE {ACTIVE}", "pairs"),
    "tagged_stations": sql("""
        SELECT location_id, capital_cca2, capital_name, capital_country, country_code
        FROM tagged""", "tagged"),
    "active_per_capital": sql(f"""
        SELECT capital_cca2, capital_name, count(*) AS active_locations FROM pairs
        WHERE {ACTIVE} GROUP BY capital_cca2, capital_name""", "pairs"),
    "capital_survey": sql("SELECT * FROM survey", "survey"),
    "capital_survey_covered": sql("""
        SELECT country, capital, active_locations, sensors_total, earliest_data FROM survey
        WHERE active_locations > 0
        ORDER BY active_locations DESC NULLS LAST, sensors_total DESC NULLS LAST, cca2
        LIMIT 15""", "survey"),
    "survey_errors": sql("SELECT * FROM survey_errors", "survey_errors"),
    "stations_per_page": sql(f"""
        SELECT {PAIR_COLS} FROM pairs
        QUALIFY row_number() OVER (PARTITION BY capital_cca2 ORDER BY location_id) <= 5""",
                             "pairs"),
    "survey_summary": sql("""
        SELECT count(*) AS capitals_surveyed,
               CAST(count(*) FILTER (WHERE total_locations > 0) AS BIGINT) AS with_any_data,
               CAST(count(*) FILTER (WHERE active_locations > 0) AS BIGINT) AS with_active,
               CAST(coalesce(sum(active_locations) FILTER (WHERE active_locations > 0), 0)
                    AS BIGINT) AS total_active
        FROM survey""", "survey"),
    "rows_per_sensor": sql("SELECT sensor_id, count(*) AS rows FROM meas GROUP BY sensor_id",
                           "meas"),
    "city_coords": sql(f"SELECT city, {R('lat')}, {R('lon')} FROM coords", "coords"),
    "map_alltime": sql(f"""
        SELECT city, country, parameter, {R('avg_value')}, {R('lat')}, {R('lon')}
        FROM alltime""", "alltime"),
    "alltime_top15": sql(f"""
        SELECT city, country, {R('avg_value')} FROM alltime
        ORDER BY avg_value DESC, city, country LIMIT 15""", "alltime"),
    "monthly_explorer": sql(f"""
        SELECT parameter, city, country, ym, {R('avg_value')}, {R('lat')}, {R('lon')}
        FROM monthly""", "monthly"),
    "monthly_top15": sql(f"""
        SELECT parameter, ym, month_rank, city, country, {R('avg_value')},
               {rnd(label('avg_value'))} AS label_value
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY parameter, ym
                                                ORDER BY avg_value DESC, city, country)
                             AS INTEGER) AS month_rank
              FROM monthly)
        WHERE month_rank <= 15""", "monthly"),
    "colour_caps": sql(f"SELECT parameter, {R('cmax')}, {R('xmax')} FROM caps", "caps"),
    "value_quantiles": sql(f"""
        SELECT parameter, count(value) AS n, {rnd('quantile_cont(value, 0.5)')} AS median,
               {rnd('quantile_cont(value, 0.95)')} AS q95,
               {rnd('quantile_cont(value, 0.98)')} AS q98
        FROM stg GROUP BY parameter HAVING count(value) > 0""", "stg"),
    "alltime_colour_caps": sql(f"""
        SELECT parameter, {rnd('quantile_cont(avg_value, 0.95)')} AS cmax,
               {rnd('quantile_cont(avg_value, 0.98) * ' + D('1.05'))} AS xmax
        FROM alltime GROUP BY parameter""", "alltime"),
    "map_frames": sql(f"""
        SELECT m.parameter, m.ym, m.city, m.country, {rnd('m.lat')} AS lat,
               {rnd('m.lon')} AS lon, {rnd('m.avg_value')} AS avg_value,
               {rnd("least(m.avg_value, c.cmax) / nullif(c.cmax, 0) * " + D('26') + " + " + D('4'))}
                 AS marker_size,
               {rnd(label('m.avg_value'))} AS label_value
        FROM monthly m JOIN caps c ON m.parameter = c.parameter""", "monthly", "caps"),
    "latest_month": sql(f"""
        SELECT parameter, city, country, ym, {R('avg_value')}, {R('lat')}, {R('lon')}
        FROM monthly m
        WHERE ym = (SELECT max(ym) FROM monthly x WHERE x.parameter = m.parameter)""",
                        "monthly"),
    "distinct_values": sql("""
        SELECT DISTINCT 'city' AS list_name, city AS value FROM cda
        UNION ALL SELECT DISTINCT 'parameter', parameter FROM cda
        UNION ALL SELECT DISTINCT 'country', country FROM cda
        UNION ALL SELECT DISTINCT 'ym', ym FROM monthly""", "cda", "monthly"),
    "city_trend": sql(f"""
        SELECT reading_date, {R('avg_value')} FROM cda
        WHERE city = 'NATION_19' AND parameter = 'pm25' ORDER BY reading_date, country""", "cda"),
    "alerts_filtered": sql(f"""
        SELECT city, country, reading_date, {R('pm25_avg_value')} FROM alerts
        WHERE country IN ('ASIA', 'EUROPE')
          AND reading_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""", "alerts"),
    "alerts_shown": sql("""
        SELECT CAST(count(*) FILTER (WHERE country IN ('ASIA', 'EUROPE')
                     AND reading_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')
                    AS BIGINT) AS shown,
               count(*) AS total FROM alerts""", "alerts"),
    "unit_split": sql("""
        SELECT parameter_name, parameter_units, count(*) AS rows FROM meas
        GROUP BY parameter_name, parameter_units""", "meas"),
    "quality_profile": sql("""
        SELECT count(*) AS total_rows,
               count(*) FILTER (WHERE value_avg IS NULL) AS null_values,
               count(*) FILTER (WHERE value_avg < 0) AS negative_values,
               count(*) FILTER (WHERE value_avg >= 10000) AS over_range_values,
               count(*) FILTER (WHERE percent_complete < 75) AS below_completeness,
               count(*) FILTER (WHERE lower(parameter_name)
                                NOT IN ('pm25', 'pm10', 'no2', 'co', 'o3', 'so2')) AS non_target
        FROM meas""", "meas"),
    "dq_not_null": sql("SELECT sensor_id, date_utc FROM meas WHERE value_avg IS NULL", "meas"),
    "dq_unique": sql(f"""
        SELECT {MID} AS measurement_id, count(*) AS n_records FROM readings
        GROUP BY 1 HAVING count(*) > 1""", "readings"),
    "dq_accepted_values": sql("""
        SELECT lower(parameter_name) AS parameter, count(*) AS n_records FROM meas
        GROUP BY 1 HAVING lower(parameter_name) NOT IN ('pm25', 'pm10', 'no2', 'co', 'o3', 'so2')""",
                              "meas"),
    "dq_non_negative": sql(f"SELECT sensor_id, date_utc, {R('value')} FROM converted WHERE value < 0",
                           "converted"),
    "dq_cross_border": sql("""
        SELECT count(*) FILTER (WHERE capital_cca2 IS DISTINCT FROM country_code)
               AS cross_border_stations FROM locs""", "locs"),
    "city_daily_confidence": sql(f"""
        SELECT city, country, parameter, CAST(date_utc AS DATE) AS reading_date,
               {rnd('avg(value)')} AS avg_value, {rnd('max(max_value)')} AS max_value,
               count(*) AS num_readings, count(DISTINCT location_id) AS station_count,
               CASE WHEN count(DISTINCT location_id) <= 2 THEN 'low' ELSE 'normal' END
                 AS confidence
        FROM stg_full GROUP BY city, country, parameter, CAST(date_utc AS DATE)""",
                                 "stg_full"),
    "city_daily_region": sql(f"""
        SELECT d.capital_cca2, d.city, d.country, d.parameter, d.reading_date,
               {rnd('d.avg_value')} AS avg_value, {rnd('d.max_value')} AS max_value,
               d.num_readings, c.region, c.subregion
        FROM (SELECT city, country, parameter, capital_cca2,
                     CAST(date_utc AS DATE) AS reading_date, avg(value) AS avg_value,
                     max(max_value) AS max_value, count(*) AS num_readings
              FROM stg_full GROUP BY ALL) d
        LEFT JOIN countries c ON c.alpha_2 = d.capital_cca2""", "stg_full", "countries"),
    "who_flags": sql(f"""
        SELECT city, country, parameter, reading_date, {R('avg_value')},
               CASE WHEN parameter = 'pm25' THEN avg_value > 25 END AS exceeds_who_24h,
               CASE WHEN parameter = 'pm25'
                    THEN avg(avg_value) OVER (PARTITION BY city, country, parameter,
                                                           year(reading_date)) > 15 END
                 AS exceeds_who_annual,
               CASE WHEN parameter = 'o3'
                    THEN 'guideline is an 8-hour mean; daily mean not comparable' END AS caveat
        FROM cda""", "cda"),
    "cap_outliers": sql(f"""
        SELECT {MID} AS measurement_id, city, country, parameter,
               {rnd(conv('least(value_avg, 10000)'))} AS value,
               {rnd(conv('value_max'))} AS max_value, 'ug/m3' AS unit, date_utc,
               {R('percent_complete')}
        FROM joined
        WHERE least(value_avg, 10000) >= 0 AND percent_complete >= 75
          AND parameter IN ('pm25', 'pm10', 'no2', 'co', 'o3', 'so2') AND city IS NOT NULL
          AND NOT (unit = 'ppm' AND least(value_avg, 10000) > 50)
          AND NOT (unit = 'ppb' AND least(value_avg, 10000) > 50000)""", "joined"),
    "mismatch_rates": sql(f"""
        SELECT count(*) AS stations,
               {rnd("count(*) FILTER (WHERE capital_country IS DISTINCT FROM country_name) / count(*)")}
                 AS name_mismatch_rate,
               {rnd("count(*) FILTER (WHERE capital_cca2 IS DISTINCT FROM country_code) / count(*)")}
                 AS code_mismatch_rate
        FROM locs""", "locs"),
}


def _suite_sql() -> str:
    nn = "SELECT '{lbl}' AS check_name, '{model}' AS model, count(*) FILTER (WHERE {col} IS NULL) AS failing_rows FROM {src}"
    av = ("SELECT '{lbl}' AS check_name, '{model}' AS model, (SELECT count(*) FROM (SELECT {col} "
          "FROM {src} GROUP BY {col} HAVING {col} NOT IN ('pm25', 'pm10', 'no2', 'co', 'o3', 'so2')))"
          " AS failing_rows")
    parts = []
    spec = [
        ("stg_air_quality", "stg", "not_null", "measurement_id"),
        ("stg_air_quality", "stg", "unique", "measurement_id"),
        ("stg_air_quality", "stg", "not_null", "city"),
        ("stg_air_quality", "stg", "not_null", "parameter"),
        ("stg_air_quality", "stg", "accepted_values", "parameter"),
        ("stg_air_quality", "stg", "not_null", "value"),
        ("stg_air_quality", "stg", "expression", "value"),
        ("city_daily_avg", "cda", "not_null", "city"),
        ("city_daily_avg", "cda", "not_null", "parameter"),
        ("city_daily_avg", "cda", "accepted_values", "parameter"),
        ("city_daily_avg", "cda", "not_null", "avg_value"),
        ("kpi_summary", "kpi", "not_null", "cities_monitored"),
        ("city_pollution_ranking", "ranking", "not_null", "city"),
        ("city_pollution_ranking", "ranking", "not_null", "parameter"),
        ("city_pollution_ranking", "ranking", "accepted_values", "parameter"),
        ("who_pm25_alerts", "alerts", "not_null", "city"),
        ("who_pm25_alerts", "alerts", "not_null", "pm25_avg_value"),
    ]
    for model, src, kind, col in spec:
        lbl = f"{kind}_{model}_{col}"
        if kind == "not_null":
            parts.append(nn.format(lbl=lbl, model=model, col=col, src=src))
        elif kind == "accepted_values":
            parts.append(av.format(lbl=lbl, model=model, col=col, src=src))
        elif kind == "unique":
            parts.append(f"SELECT '{lbl}' AS check_name, '{model}' AS model, (SELECT count(*) FROM "
                         f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
                         f"HAVING count(*) > 1)) AS failing_rows")
        else:
            parts.append(f"SELECT 'assert_value_non_negative' AS check_name, '{model}' AS model, "
                         f"count(*) FILTER (WHERE value < 0) AS failing_rows FROM {src}")
    body = "\nUNION ALL ".join(parts)
    return sql(f"SELECT check_name, model, CAST(failing_rows AS BIGINT) AS failing_rows, "
               f"failing_rows = 0 AS passed FROM ({body})", "stg", "cda", "kpi", "ranking",
               "alerts")


ORACLE["dq_suite"] = _suite_sql()
