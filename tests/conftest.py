import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cityair import build_session, checkpoint_dir
    s = build_session("local[*]", shuffle_partitions=8)
    checkpoint_dir(s)  # only fills spark.checkpoint.dir when unset
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def duck_at():
    """DuckDB connection with the driver's tables of one folder as views."""
    import duckdb
    cons = {}

    def get(sf_dir):
        if sf_dir not in cons:
            con = duckdb.connect()
            for t in ("region nation customer supplier part orders lineitem events documents "
                      "embeddings pages benchmark labels conversations").split():
                con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
            cons[sf_dir] = con
        return cons[sf_dir]
    return get
