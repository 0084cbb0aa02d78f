"""Data-quality checks as table operations.

Every check returns the failing rows; zero rows means the check passes. The
suite runner evaluates all row-level checks of one model in a single
aggregation pass (one ``count_if`` per check) instead of one scan per check.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityair.functions import constants as K
from cityair.functions.expressions import count_where


# ---- single checks (failing rows) -------------------------------------------
def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once; NULLs are not checked."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def accepted_values_failures(df: DataFrame, column: str,
                             values: Iterable[str] = K.TARGET_POLLUTANTS) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .where(~F.col(column).isin(list(values))))


def expression_failures(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows matching a failure predicate, e.g. ``value < 0``."""
    return df.where(predicate)


def cross_border_failures(locations: DataFrame) -> DataFrame:
    """Stations whose ISO code differs from their capital's (NULL-aware)."""
    return locations.where(~F.col("capital_cca2").eqNullSafe(F.col("country_code")))


# ---- suite ------------------------------------------------------------------
@dataclass(frozen=True)
class Check:
    model: str
    kind: str                 # not_null | unique | accepted_values | expression
    column: str | None = None
    values: tuple = field(default=K.TARGET_POLLUTANTS)
    predicate: str | None = None   # SQL failure predicate for kind=expression
    name: str | None = None

    @property
    def label(self) -> str:
        if self.name:
            return self.name
        return f"{self.kind}_{self.model}_{self.column}"

    def failing(self) -> Column:
        """Row-level failure condition (not used for ``unique``)."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(list(self.values))
        if self.kind == "expression":
            return F.expr(self.predicate)
        raise ValueError(self.kind)


def run_suite(models: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(check_name, model, failing_rows, passed)`` for every check.

    Per model, the row checks and one accepted-values check share a single
    aggregation: group by the accepted-values column (few distinct values,
    combined map side), count each row failure per group, then fold the
    groups (failing values = groups outside the list). ``unique`` needs its
    own group-by on the checked column. Failing-row counts follow the generic
    tests: accepted-values counts failing *values*, unique counts duplicated
    values.
    """
    parts = []
    for model, df in models.items():
        mine = [c for c in checks if c.model == model]
        row_checks = [c for c in mine if c.kind in ("not_null", "expression")]
        value_checks = [c for c in mine if c.kind == "accepted_values"]
        grouped_by = value_checks[0] if value_checks else None
        aggs = [count_where(c.failing()).alias(f"r{i}") for i, c in enumerate(row_checks)]
        if grouped_by is not None:
            g = df.groupBy(F.col(grouped_by.column).alias("__v")).agg(
                F.count(F.lit(1)).alias("__n"), *aggs)
            folded = g.agg(*[F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"c{i}")
                             for i in range(len(row_checks))],
                           count_where(~F.col("__v").isin(list(grouped_by.values)))
                           .alias(f"c{len(row_checks)}"))
            parts.append(_unpivot(folded, [c.label for c in row_checks] + [grouped_by.label],
                                  model))
        elif row_checks:
            folded = df.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)])
            parts.append(_unpivot(folded, [c.label for c in row_checks], model))
        for c in value_checks[1:]:
            n = accepted_values_failures(df, c.column, c.values).agg(
                F.count(F.lit(1)).alias("c0"))
            parts.append(_unpivot(n, [c.label], model))
        for c in (c for c in mine if c.kind == "unique"):
            n = unique_failures(df, c.column).agg(F.count(F.lit(1)).alias("c0"))
            parts.append(_unpivot(n, [c.label], model))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failing_rows") == 0)


def _unpivot(one_row: DataFrame, labels: list[str], model: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(lbl).alias("check_name"),
                               F.col(f"c{i}").cast("long").alias("failing_rows"))
                      for i, lbl in enumerate(labels)])
    return (one_row.select(F.explode(pairs).alias("p"))
                   .select(F.col("p.check_name").alias("check_name"),
                           F.lit(model).alias("model"),
                           F.col("p.failing_rows").alias("failing_rows")))


def reference_checks() -> list[Check]:
    """The seventeen checks guarding the staging model and the marts."""
    acc = "accepted_values"
    return [
        Check("stg_air_quality", "not_null", "measurement_id"),
        Check("stg_air_quality", "unique", "measurement_id"),
        Check("stg_air_quality", "not_null", "city"),
        Check("stg_air_quality", "not_null", "parameter"),
        Check("stg_air_quality", acc, "parameter"),
        Check("stg_air_quality", "not_null", "value"),
        Check("stg_air_quality", "expression", predicate="value < 0",
              name="assert_value_non_negative"),
        Check("city_daily_avg", "not_null", "city"),
        Check("city_daily_avg", "not_null", "parameter"),
        Check("city_daily_avg", acc, "parameter"),
        Check("city_daily_avg", "not_null", "avg_value"),
        Check("kpi_summary", "not_null", "cities_monitored"),
        Check("city_pollution_ranking", "not_null", "city"),
        Check("city_pollution_ranking", "not_null", "parameter"),
        Check("city_pollution_ranking", acc, "parameter"),
        Check("who_pm25_alerts", "not_null", "city"),
        Check("who_pm25_alerts", "not_null", "pm25_avg_value"),
    ]


# ---- profiles ---------------------------------------------------------------
def quality_profile(measurements: DataFrame) -> DataFrame:
    """One pass over the fact: rows per cleaning rule and in total."""
    v = F.col("value_avg")
    return measurements.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_where(v.isNull()).alias("null_values"),
        count_where(v < 0).alias("negative_values"),
        count_where(v >= K.OVER_RANGE).alias("over_range_values"),
        count_where(F.col("percent_complete") < K.MIN_PERCENT_COMPLETE).alias("below_completeness"),
        count_where(~F.lower("parameter_name").isin(list(K.TARGET_POLLUTANTS))).alias("non_target"),
    )


def unit_split(measurements: DataFrame) -> DataFrame:
    """Rows per (parameter, unit) pair as reported."""
    return (measurements.groupBy("parameter_name", "parameter_units")
            .agg(F.count(F.lit(1)).alias("rows")))


def cross_border_count(locations: DataFrame) -> DataFrame:
    return locations.agg(
        count_where(~F.col("capital_cca2").eqNullSafe(F.col("country_code")))
        .alias("cross_border_stations"))


def mismatch_rates(locations: DataFrame) -> DataFrame:
    """Share of stations whose country *name* differs from the capital's,
    against the share whose ISO *code* differs."""
    n = F.count(F.lit(1))
    return locations.agg(
        n.alias("stations"),
        F.try_divide(count_where(~F.col("capital_country").eqNullSafe(F.col("country_name"))), n)
         .alias("name_mismatch_rate"),
        F.try_divide(count_where(~F.col("capital_cca2").eqNullSafe(F.col("country_code"))), n)
         .alias("code_mismatch_rate"),
    )
