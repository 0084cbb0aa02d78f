"""Build the models the way the transformation step does: staging stays a
view (a lazy plan), the city-day mart is written as a table partitioned by
pollutant, and the three view marts are plans over that table.

Reading the table back with its explicit schema gives partition pruning on
``parameter`` to every consumer (``WHERE parameter = 'pm25'`` reads one
folder, also through the ranking window, whose partition key it is).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cityair import schemas
from cityair.plans import marts, staging
from cityair.sources import sinks


@dataclass
class Models:
    stg_air_quality: DataFrame
    city_daily_avg: DataFrame
    city_pollution_ranking: DataFrame
    kpi_summary: DataFrame
    who_pm25_alerts: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def build_models(measurements: DataFrame, sensors: DataFrame, locations: DataFrame,
                 weights: DataFrame, table_path: str | None = None) -> Models:
    """Write ``city_daily_avg`` (to ``table_path``, or to the checkpoint
    folder when None) and return every model as a DataFrame."""
    stg = staging.stg_air_quality(measurements, sensors, locations, weights)
    cda_plan = marts.city_daily_avg(stg)
    if table_path is None:
        table_path = sinks.scratch_path(cda_plan.sparkSession, "city_daily_avg")
    sinks.write_table(cda_plan, table_path, partition_by=("parameter",))
    cda = sinks.read_table(cda_plan.sparkSession, table_path, schemas.CITY_DAILY_AVG)
    return Models(stg, cda, marts.pollution_ranking(cda), marts.kpi_summary(cda),
                  marts.pm25_alerts(cda))


def register_views(models: Models | dict, prefix: str = "") -> list[str]:
    """Expose each model to SQL under its name (``spark.sql('SELECT … FROM
    city_pollution_ranking …')``), the way consumers read the models."""
    frames = models.as_dict() if isinstance(models, Models) else dict(models)
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
