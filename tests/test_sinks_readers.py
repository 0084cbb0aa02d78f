"""CSV readers, report sink, model tables and cluster sizing."""

import os

from pyspark.sql import functions as F

from cityair import schemas
from cityair.catalog import QUERIES
from cityair.session import cluster_conf
from cityair.sources import seeds, sinks, standins as S
from conftest import SF0001


def test_capitals_csv_reader(spark, scratch):
    path = os.path.join(scratch, "capitals.csv")
    with open(path, "w") as f:
        f.write("country,cca2,capital,lat,lon\nA,AA,Alpha,1.5,-2.25\nB,BB,,,\n")
    rows = {r.cca2: r for r in seeds.read_capitals_csv(spark, path).collect()}
    assert rows["AA"].lat == 1.5 and rows["AA"].lon == -2.25
    assert rows["BB"].capital is None and rows["BB"].lat is None


def test_survey_report_csv(spark, scratch):
    survey = QUERIES["capital_survey"](spark, SF0001)
    out = os.path.join(scratch, "report")
    sinks.write_report_csv(survey, out)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(os.path.join(out, files[0])).read().splitlines()
    assert lines[0].split(",")[:3] == ["country", "cca2", "capital"]
    assert len(lines) == 1 + survey.count()


def test_model_table_roundtrip_and_empty_write(spark, scratch):
    cda = QUERIES["city_daily_avg"](spark, SF0001)
    path = os.path.join(scratch, "cda")
    sinks.write_table(cda, path, partition_by=("parameter",))
    back = sinks.read_table(spark, path, schemas.CITY_DAILY_AVG)
    assert back.count() == cda.count()
    empty = os.path.join(scratch, "empty")
    sinks.write_table(cda.where(F.lit(False)), empty, partition_by=("parameter",))
    assert sinks.read_table(spark, empty, schemas.CITY_DAILY_AVG).count() == 0


def test_cluster_sizing():
    conf = cluster_conf(100 * 2 ** 40, executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(2 ** 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80


def test_models_as_sql_views(spark, scratch):
    from cityair.catalog import world
    from cityair.plans.models import build_models, register_views
    w = world(spark, SF0001)
    names = register_views(build_models(w.measurements, w.sensors, w.locations, w.weights,
                                        scratch + "/cda"))
    assert "city_pollution_ranking" in names
    top = spark.sql("""
        SELECT city, overall_avg_value FROM city_pollution_ranking
        WHERE parameter = 'pm25' ORDER BY pollution_rank, city LIMIT 10""").collect()
    ref = QUERIES["top10_pm25"](spark, SF0001).collect()
    assert [r.city for r in top] == [r.city for r in ref]
    kpi = spark.sql("SELECT * FROM kpi_summary").first()
    assert kpi.total_readings == 336


def test_run_survey_writes_report(spark, scratch):
    from cityair.plans.survey import run_survey
    summary, top = run_survey(S.capitals(spark, SF0001), S.stations(spark, SF0001, with_sensor_count=True),
                              S.AS_OF, scratch + "/report")
    assert summary.first().capitals_surveyed == 26
    assert top.count() == 15
    assert any(f.endswith(".csv") for f in os.listdir(scratch + "/report"))


def test_partitioned_writes_are_clustered(spark, scratch):
    """One file per partition value here (not one per task and value)."""
    import glob
    df = spark.range(0, 4000).repartition(8).withColumn("p", (F.col("id") % 4).cast("string"))
    sinks.write_table(df, scratch + "/t", partition_by=("p",))
    counts = [len(glob.glob(d + "/*.parquet")) for d in glob.glob(scratch + "/t/p=*")]
    assert len(counts) == 4 and max(counts) == 1
