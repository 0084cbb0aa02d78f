"""Load verification from the write job itself.

``DataFrame.observe`` adds counters to the plan that writes a table: rows and
NULLs of chosen columns are counted by the tasks that write, so verifying a
load reads nothing again. The figures of each load are kept in a small log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityair.functions.expressions import count_where

LOG = "table_name string, run_ts timestamp, rows long, nulls map<string, long>"


def counters(columns: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"),
            *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in columns]]


def write_observed(df: DataFrame, write: Callable[[DataFrame], None],
                   columns: Sequence[str] = ()) -> dict:
    """Run ``write(df)`` and return what its job counted:
    ``{"rows": n, "nulls": {column: n}}``."""
    seen = Observation()
    write(df.observe(seen, *counters(columns)))
    got = seen.get
    return {"rows": got["rows"], "nulls": {c: got[f"null_{c}"] for c in columns}}


class Watch:
    """Collects the figures of one load's writes: ``watch(name, columns)`` is a
    writer to pass where a sink takes ``through``."""

    def __init__(self):
        self.figures: dict[str, dict] = {}

    def __call__(self, table: str, columns: Sequence[str] = ()):
        def through(df: DataFrame, write: Callable[[DataFrame], None]) -> None:
            self.figures[table] = write_observed(df, write, columns)
        return through


def log(spark: SparkSession, path: str, run_ts, figures: dict[str, dict]) -> DataFrame:
    """Append one load's figures (a row a table) to the log at ``path``."""
    rows = spark.createDataFrame([(t, f["rows"], f["nulls"]) for t, f in figures.items()],
                                 "table_name string, rows long, nulls map<string, long>")
    out = rows.select("table_name", F.lit(run_ts).cast("timestamp").alias("run_ts"), "rows",
                      "nulls")
    out.write.mode("append").parquet(path)
    return out


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(path)


def null_shares(figures: DataFrame) -> DataFrame:
    """(table_name, column_name, rows, nulls, null_share) of logged figures."""
    return figures.select("table_name", "rows", F.explode("nulls").alias("column_name", "nulls")) \
        .select("table_name", "column_name", "rows", "nulls",
                F.try_divide(F.col("nulls").cast("double"), F.col("rows")).alias("null_share"))

