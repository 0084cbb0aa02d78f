"""Every registered query against its DuckDB oracle (sf0.001 by default;
``PARITY_SF_DIR=/root/testdata/sf0.01`` runs the driver's scale)."""

import math
import os

import pytest

import __spark_entry__ as E
from conftest import SF0001

SF_DIR = os.environ.get("PARITY_SF_DIR", SF0001)

NAMES = sorted(E.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["city", "overall_avg_value", "pollution_rank"]
    assert 0 < len(rows) <= 10
    assert [r.pollution_rank for r in rows] == sorted(r.pollution_rank for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_at, name):
    duck = duck_at(SF_DIR)
    sdf = E.queries()[name](spark, SF_DIR)
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    orows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert sorted(srows, key=_key) == sorted(orows, key=_key)
