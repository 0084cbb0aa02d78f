"""Driver contract: the entry module and the bench output format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "top10_pm25",
                          "kpi_summary"], capture_output=True, text=True, env=env,
                         cwd=tmp_path, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert {"top10_pm25", "kpi_summary", "ingest_raw", "build_models"} <= set(rec["queries"])


def test_entry_module_contract():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    assert callable(E.entry)
    q, o = E.queries(), E.oracle_sql()
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert len(own) >= 58 and own <= set(o) and set(o) <= set(q)
    assert all(isinstance(s, str) and s.strip() for s in o.values())


def test_other_queries_survive_a_package_that_the_subpackage_misses():
    """Any ImportError below the optional subpackage leaves the rest registered."""
    code = ("import sys; sys.modules['xxhash'] = None; sys.path.insert(0, %r)\n"
            "import __spark_entry__ as E\n"
            "names = set(E.queries()); assert 'kpi_summary' in names, names\n"
            "assert set(E.oracle_sql()) <= names\n"
            "assert not [n for n in names if n.startswith('op') or n == 'pipeline'], names" % ROOT)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
