"""Exact order statistics and ranks without gathering a group in one task.

``exact_quantiles`` selects by rank: a mergeable sketch proposes a bracket
around each wanted rank, exact counts confirm it (or the part beside it that
holds the rank), and the next round looks at the bracket's rows only, a few
thousandths of the round before. Brackets of a bounded number of rows are
sorted; one whose ends are equal is its own answer. The sketch decides how
fast it ends, never the result.

``ranked`` ranks distinct values: ranges of values (by sketched splitters)
hold few of them each, a range's offset is the number of rows in the ranges
before it, and a value's rank is that plus the rows of larger values in its
own range. Rows of one value, however many, are one row there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityair.functions.expressions import count_where
from cityair.operators.joins import broadcast_if_bounded
from cityair.sources import sinks

GATHER_ROWS = 100_000       # rows of one bracket or range that a task may sort
GRID = 1000                 # sketched quantiles of a bracket
ACCURACY = 10_000           # of the sketch: finer than the grid
MAX_BROADCAST_GROUPS = 100_000
MAX_RANGES = 10_000


def _key(group: Sequence[str]) -> Column:
    """The group as one column (NULLs in it are equal)."""
    return F.struct(*group) if group else F.struct(F.lit(0).alias("all"))


def _meet(rows: DataFrame, few: DataFrame, names: Sequence[str]) -> DataFrame:
    """Equi-join on ``names`` (NULLs are equal), broadcasting a bounded side."""
    side = broadcast_if_bounded(few.withColumnsRenamed({n: f"{n}__" for n in names}),
                                MAX_BROADCAST_GROUPS)
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"{n}__"))
    return rows.join(side, cond).drop(*[f"{n}__" for n in names])


def _narrow(rows: DataFrame, open_: DataFrame) -> DataFrame:
    """The open brackets (key, rank, lo, hi, below, inside) after one round.
    A bracket holds the rows of its key from ``lo`` to ``hi``: ``inside`` of
    them, with ``below`` rows of the key before."""
    inside = lambda r: r.where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketched = inside(_meet(rows, open_, ["key"])).groupBy("key", "rank").agg(
        F.percentile_approx("v", grid, ACCURACY).alias("g"))
    at = F.floor((F.col("rank") - F.col("below")) * GRID / F.col("inside")).cast("int")
    proposed = _meet(open_, sketched, ["key", "rank"]).select(
        *open_.columns,
        F.element_at("g", F.greatest(at, F.lit(1))).alias("lo2"),
        F.element_at("g", F.least(at + 3, F.lit(GRID + 1))).alias("hi2"))
    proposed = sinks.materialize(proposed, "quantile_brackets")
    v, lo2, hi2 = F.col("v"), F.col("lo2"), F.col("hi2")
    counts = inside(_meet(rows, proposed, ["key"])).groupBy("key", "rank").agg(
        count_where(v < lo2).alias("under"), count_where(v == lo2).alias("at_lo"),
        count_where((v > lo2) & (v < hi2)).alias("between"),
        count_where((v == hi2) & (hi2 > lo2)).alias("at_hi"),
        F.max(F.when(v < lo2, v)).alias("last_under"),
        F.min(F.when((v > lo2) & (v < hi2), v)).alias("first_between"),
        F.max(F.when((v > lo2) & (v < hi2), v)).alias("last_between"),
        F.min(F.when(v > hi2, v)).alias("first_over"))
    both = _meet(proposed, counts, ["key", "rank"])
    r = F.col("rank") - F.col("below")
    under, at_lo, between, at_hi = (F.col(c) for c in ("under", "at_lo", "between", "at_hi"))
    case = (F.when(r < under, 0).when(r < under + at_lo, 1).when(r < under + at_lo + between, 2)
             .when(r < under + at_lo + between + at_hi, 3).otherwise(4))
    pick = lambda *c: F.element_at(F.array(*c), F.col("case") + 1)
    before = [F.lit(0).cast("long"), under, under + at_lo, under + at_lo + between,
              under + at_lo + between + at_hi]
    held = [under, at_lo, between, at_hi, F.col("inside") - before[4]]
    return both.withColumn("case", case).select(
        "key", "rank",
        pick(F.col("lo"), lo2, F.col("first_between"), hi2, F.col("first_over")).alias("lo"),
        pick(F.col("last_under"), lo2, F.col("last_between"), hi2, F.col("hi")).alias("hi"),
        (F.col("below") + pick(*before)).alias("below"), pick(*held).alias("inside"))


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probabilities,
                    gather: int = GATHER_ROWS) -> DataFrame:
    """(group..., n, q array<double>): exact quantiles of each group with linear
    interpolation between ranks, equal to ``percentile``. NULL values don't
    count; groups without any other have no row."""
    group, probs = list(group), [float(p) for p in probabilities]
    rows = df.select(_key(group).alias("key"), F.col(value).cast("double").alias("v")).where(
        "v IS NOT NULL")
    sizes = sinks.materialize(rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")),
        "quantile_sizes")
    place = [F.lit(p) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in place
                                       for f in (F.floor, F.ceil)]))
    state = sizes.select("key", F.explode(ranks).alias("rank"), "lo", "hi",
                         F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    state = sinks.materialize(state, "quantile_state")
    wide = (F.col("inside") > gather) & (F.col("lo") < F.col("hi"))
    while not state.where(wide).isEmpty():  # a few rounds: brackets shrink some 300 times
        state = sinks.materialize(state.where(~wide).unionByName(
            _narrow(rows, state.where(wide))), "quantile_state")
    known = state.where("lo = hi").select("key", "rank", F.col("lo").alias("x"))
    left = _meet(rows, state.where("lo < hi"), ["key"]).where("v >= lo AND v <= hi")
    sorted_ = left.groupBy("key", "rank", "below").agg(
        F.sort_array(F.collect_list("v")).alias("all")).select(
        "key", "rank", F.element_at("all", (F.col("rank") - F.col("below") + 1).cast("int"))
        .alias("x"))
    found = known.unionByName(sorted_).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))

    def interpolated(p: Column) -> Column:
        low, high = F.floor(p), F.ceil(p)
        a, b = (F.col("at")[x.cast("long")] for x in (low, high))
        return F.when((low == high) | (a == b), a).otherwise((high - p) * a + (p - low) * b)

    return _meet(sizes, found, ["key"]).select(
        *[F.col("key")[c].alias(c) for c in group], "n", F.array(*[interpolated(p) for p in place]).alias("q"))


def ranked(df: DataFrame, part: Sequence[str], value: str, out: str,
           range_rows: int = GATHER_ROWS) -> DataFrame:
    """``df`` with ``rank()`` of ``value`` within ``part``, largest first and
    NULLs before all, as column ``out``. ``df`` is written once."""
    part = list(part)
    df = sinks.materialize(df, "rank_rows")
    values = sinks.materialize(df.groupBy(_key(part).alias("key"), F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("rows")), "rank_values")
    n = values.count()
    ranges = max(2, min(MAX_RANGES, -(-n // range_rows)))
    cuts = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    split = sinks.materialize(values.groupBy("key").agg(
        F.percentile_approx("v", cuts, 10 * ranges).alias("cuts")), "rank_splitters")
    # Range 0 holds NULL, then the largest values; a group of NULLs has no cuts.
    larger = F.size(F.filter(F.coalesce("cuts", F.expr("CAST(array() AS array<double>)")),
                             lambda c: c >= F.col("v")))
    placed = _meet(values, split, ["key"]).withColumn(
        "range", F.when(F.col("v").isNull(), 0).otherwise(larger + 1)).drop("cuts")
    totals = placed.groupBy("key", "range").agg(F.sum("rows").alias("in_range"))
    ahead = Window.partitionBy("key").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)  # a row a range: at most ``ranges`` + 1
    offsets = totals.select("key", "range", F.coalesce(
        F.sum("in_range").over(ahead), F.lit(0)).alias("offset"))
    within = Window.partitionBy("key", "range").orderBy(F.desc_nulls_first("v")).rowsBetween(
        Window.unboundedPreceding, -1)
    local = placed.withColumn("local", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    ranks = _meet(local, offsets, ["key", "range"]).select(
        F.col("key").alias("key__"), F.col("v").alias("value__"),
        (F.col("offset") + F.col("local") + 1).cast("int").alias("rank__"))
    return df.join(ranks, _key(part).eqNullSafe(F.col("key__"))
                   & F.col(value).eqNullSafe(F.col("value__"))).select(
        *df.columns, F.col("rank__").alias(out))
