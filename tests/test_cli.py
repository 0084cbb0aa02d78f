"""The command line runs the steps end to end."""

import os

from cityair.__main__ import main
from cityair.sources import standins as S
from conftest import SF0001

TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def test_cli_steps(spark, scratch, capsys):
    land = os.path.join(scratch, "landing")
    S.country_payloads(spark, SF0001).write.json(land + "/countries")
    S.location_payloads(spark, SF0001, False).write.json(land + "/locations")
    S.day_envelopes(spark, SF0001).write.options(**TS).json(land + "/days")
    raw = os.path.join(scratch, "raw")
    assert main(["ingest", "--countries", land + "/countries", "--locations", land + "/locations",
                 "--days", land + "/days", "--raw", raw, "--run-ts", S.RUN_TS,
                 "--as-of", S.AS_OF]) == 0
    assert "measurements 792" in capsys.readouterr().out
    assert main(["check", "--raw", raw]) == 0
    out = capsys.readouterr().out
    assert out.count("PASS") == 17
    assert main(["survey", "--countries", land + "/countries", "--locations", land + "/locations",
                 "--as-of", S.AS_OF, "--report", scratch + "/report"]) == 0
    assert any(f.endswith(".csv") for f in os.listdir(scratch + "/report"))
