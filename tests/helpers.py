"""Hand-written rows with the raw schemas (defaults for unused columns)."""

import datetime as dt

from cityair import schemas

DAY = dt.datetime(2024, 1, 2, 0, 0, 0)


def measurement(sensor_id, value, parameter="no2", units="ppb", pct=100.0, day=DAY,
                value_max=None, ingested_at=None):
    row = {f.name: None for f in schemas.MEASUREMENTS_DAILY.fields}
    row.update(sensor_id=sensor_id, date_utc=day, value_avg=value,
               value_max=value if value_max is None else value_max,
               parameter_name=parameter, parameter_units=units, percent_complete=pct,
               ingested_at=ingested_at or day)
    return tuple(row[f.name] for f in schemas.MEASUREMENTS_DAILY.fields)


def sensor(sensor_id, location_id):
    row = {f.name: None for f in schemas.SENSORS.fields}
    row.update(sensor_id=sensor_id, location_id=location_id)
    return tuple(row[f.name] for f in schemas.SENSORS.fields)


def location(location_id, city, country="C", cca2="AA", code="AA", lat=0.0, lon=0.0,
             last=None, first=None, ingested_at=None, capital_country=None):
    row = {f.name: None for f in schemas.LOCATIONS.fields}
    row.update(location_id=location_id, capital_name=city, country_name=country,
               capital_cca2=cca2, country_code=code, latitude=lat, longitude=lon,
               datetime_last_utc=last, datetime_first_utc=first,
               ingested_at=ingested_at or DAY, capital_country=capital_country or city)
    return tuple(row[f.name] for f in schemas.LOCATIONS.fields)


def frames(spark, meas, sens, locs):
    return (spark.createDataFrame(meas, schemas.MEASUREMENTS_DAILY),
            spark.createDataFrame(sens, schemas.SENSORS),
            spark.createDataFrame(locs, schemas.LOCATIONS))
