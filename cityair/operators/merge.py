"""Primary-key upsert and the incremental helpers around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NEWEST_FIRST_NULLS_LAST = 2 ** 62


def newest_first(ts) -> Column:
    """Sort key that puts the latest timestamp first and NULLs last."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(-F.unix_micros(c.cast("timestamp")), F.lit(_NEWEST_FIRST_NULLS_LAST))


def pick_per_key(df: DataFrame, keys: Sequence[str], rank: Sequence[Column]) -> DataFrame:
    """One row per key: the row whose ``rank`` tuple is smallest.

    Written as ``min(struct(rank..., row...))`` in a ``groupBy``: a declarative
    aggregate, so Spark combines map-side before the shuffle and a key holding
    a large share of the rows never lands whole in one task. Remaining ties
    are broken by the row's own columns, so the survivor is deterministic.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    rec = F.struct(*[r.alias(f"__rank{i}") for i, r in enumerate(rank)],
                   *[F.col(c) for c in others])
    return (df.groupBy(*keys).agg(F.min(rec).alias("__best"))
              .select(*keys, *[F.col("__best")[c].alias(c) for c in others])
              .select(*df.columns))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str = "ingested_at",
                   tie_break: Sequence[Column] = ()) -> DataFrame:
    """Latest ``ts`` per key, then ``tie_break`` ascending."""
    return pick_per_key(df, keys, [newest_first(ts), *tie_break])


def merge_upsert(existing: DataFrame | None, increment: DataFrame, keys: Sequence[str],
                 ts: str = "ingested_at", tie_break: Sequence[Column] = ()) -> DataFrame:
    """Insert new keys and update changed ones, without duplicates.

    ``existing ∪ increment`` reduced to the latest row per key; on an equal
    stamp the increment wins. Running it again with the same increment
    returns the same table (idempotent).
    """
    inc = increment.withColumn("__src", F.lit(0))
    if existing is None:
        both = inc
    else:
        both = existing.select(*increment.columns).withColumn("__src", F.lit(1)).unionByName(inc)
    out = latest_per_key(both, keys, ts, [F.col("__src"), *tie_break])
    return out.drop("__src")


def pending(candidates: DataFrame, completed: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Candidates whose key is not in ``completed`` (resume after a stop).

    ``completed`` may be a fact table with many rows per key: its keys are
    de-duplicated first (combined map-side), so only distinct keys cross the
    shuffle and a small result can be broadcast by AQE."""
    return candidates.join(completed.select(key).distinct(), key, "left_anti")


def month_of(ts) -> Column:
    """Partition value of the fact table: the ``yyyy-MM`` month of a timestamp."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM")


def within_window(df: DataFrame, ts: str, as_of=None, window_days: int | None = None,
                  floor=None, partition_col: str | None = None) -> DataFrame:
    """Keep ``ts >= as_of - window_days`` and/or ``ts >= floor``; both optional.

    With ``partition_col`` (a month-partitioned table, see ``month_of``) the
    same bound is also stated on the partition column, so months before the
    window are pruned from the scan instead of read and filtered."""
    cond = F.lit(True)
    bounds = []
    if window_days is not None:
        bounds.append(F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(int(window_days))))
    if floor is not None:
        bounds.append(F.lit(floor).cast("timestamp"))
    for b in bounds:
        cond = cond & (F.col(ts) >= b)
        if partition_col is not None:
            cond = cond & (F.col(partition_col) >= month_of(b))
    return df.where(cond)
