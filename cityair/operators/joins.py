"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it provably holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Beyond the bound the frame
    is returned unchanged, so Spark plans a shuffle join (with AQE skew
    splitting) instead of shipping a growing table to every executor.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
