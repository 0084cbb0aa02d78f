"""Small static inputs: the molecular-weight seed and the capitals CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cityair import schemas
from cityair.functions.constants import MOLECULAR_WEIGHTS


def molecular_weights(spark: SparkSession) -> DataFrame:
    """The six seed rows as an in-plan local relation (broadcast for free)."""
    rows = ", ".join(
        f"('{p}', {'CAST(NULL AS DOUBLE)' if w is None else f'CAST({w!r} AS DOUBLE)'})"
        for p, w in MOLECULAR_WEIGHTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(parameter, molecular_weight_g_per_mol)")


def seed_csv_text() -> str:
    """The seed as header CSV text (empty field = no weight), for landing it
    as a file where a CSV seed is expected."""
    lines = ["parameter,molecular_weight_g_per_mol"]
    lines += [f"{p},{'' if w is None else w}" for p, w in MOLECULAR_WEIGHTS]
    return "\n".join(lines) + "\n"


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV; an empty field reads as NULL."""
    return spark.read.csv(path, header=True, schema=schemas.MOLECULAR_WEIGHTS)


def read_capitals_csv(spark: SparkSession, path: str) -> DataFrame:
    """Static capitals list ``country,cca2,capital,lat,lon``."""
    return spark.read.csv(path, header=True, schema=schemas.CAPITALS)
