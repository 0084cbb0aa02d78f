"""Invariants across the model chain, on sf0.01."""

from pyspark.sql import functions as F

from cityair.catalog import world
from cityair.operators import quality
from cityair.plans.models import build_models
from conftest import SF001


def test_model_chain_invariants(spark, scratch):
    w = world(spark, SF001)
    m = build_models(w.measurements, w.sensors, w.locations, w.weights, scratch + "/cda")
    n_fact = w.measurements.count()
    n_stg = m.stg_air_quality.count()
    assert n_stg <= n_fact
    assert m.city_daily_avg.agg(F.sum("num_readings")).first()[0] == n_stg == 3147
    assert m.stg_air_quality.select("measurement_id").distinct().count() == n_stg
    k = m.kpi_summary.first()
    assert (k.cities_monitored, k.total_readings) == (25, 3147)
    assert m.city_daily_avg.count() == 2222 and m.city_pollution_ranking.count() == 144
    assert m.who_pm25_alerts.count() == 319
    suite = quality.run_suite(m.as_dict(), quality.reference_checks()).collect()
    assert len(suite) == 17 and all(r.passed for r in suite)
    assert sorted(p.name for p in __import__("pathlib").Path(scratch, "cda").iterdir()
                  if p.name.startswith("parameter="))[:1] == ["parameter=co"]
