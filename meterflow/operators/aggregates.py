"""Grouped summaries."""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import join_dimension
from .layout import Series, global_rank

_AGGREGATES = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp,
}


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a null key are left out, as the reference results do."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def sum_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums per group; a group with nothing but missing values sums to 0."""
    return _known(df, keys).groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns])


def summary_by_group(df: DataFrame, key: str, column: str, how: str = "sum", name: str | None = None) -> DataFrame:
    """One named aggregate per group: sum, mean, min, max, count, std or median."""
    name = name or column
    if how == "median":
        return median_by_group(df, key, column, name)
    if how not in _AGGREGATES:
        raise ValueError(f"unknown aggregate {how!r}")
    return _known(df, [key]).groupBy(key).agg(_AGGREGATES[how](column).alias(name))


def summaries_by_group(df: DataFrame, key: str, column: str, hows: Sequence[str]) -> DataFrame:
    """Several named aggregates per group, a column each: one pass over the table, two with the median."""
    named = [how for how in hows if how != "median"]
    unknown = [how for how in named if how not in _AGGREGATES]
    if unknown:
        raise ValueError(f"unknown aggregates {unknown}")
    if "median" in hows:
        return _with_median(df, key, column).select(key, *hows)
    result = _known(df, [key]).groupBy(key).agg(F.count("*").alias("_rows"), *[_AGGREGATES[how](column).alias(how) for how in named])
    return result.select(key, *hows)


def median_by_group(df: DataFrame, key: str, column: str, name: str, accuracy: int = 100_000) -> DataFrame:
    """Exact median per group without ordering a whole group; a group without values is left out."""
    rows = _known(df, [key]).filter(F.col(column).isNotNull())
    return _with_median(rows, key, column, accuracy).select(key, F.col("median").alias(name))


def _with_median(df: DataFrame, key: str, column: str, accuracy: int = 100_000) -> DataFrame:
    """All named aggregates and the exact median, from two passes.

    The first is a mergeable quantile sketch, off by at most 1 / accuracy of the rows, so two of its quantiles bracket
    the middle. The second reduces all rows of a group outside of the bracket to one row of partial aggregates, and those inside (a
    few in ``accuracy``) to one per value; both are combined map-side. What is left to be ordered is inside the bracket.
    """
    rows = _known(df, [key]).select(key, F.col(column).cast("double").alias("_v"))
    margin = 2 / accuracy
    bracket = rows.groupBy(key).agg(F.percentile_approx("_v", [0.5 - margin, 0.5 + margin], accuracy).alias("_b"))
    bracket = bracket.select(key, F.col("_b")[0].alias("_low"), F.col("_b")[1].alias("_high"))
    placed = join_dimension(rows, bracket, key, key, ["_low", "_high"])
    inside = F.when(F.col("_v").between(F.col("_low"), F.col("_high")), F.col("_v")).alias("_at")
    parts = placed.groupBy(key, inside).agg(
        F.count("_v").alias("_n"), F.count_if(F.col("_v") < F.col("_low")).alias("_below"), F.sum("_v").alias("_sum"), F.min("_v").alias("_min"),
        F.max("_v").alias("_max"), F.avg("_v").alias("_mean"), F.var_pop("_v").alias("_var"))
    group = Window.partitionBy(key)
    n = F.sum("_n").over(group)
    parts = parts.withColumns({"_all": n, "_under": F.sum("_below").over(group), "_center": F.sum("_sum").over(group) / F.nullif(n, F.lit(0)),
                               "_last": F.sum(F.when(F.col("_at").isNotNull(), F.col("_n"))).over(group.orderBy("_at"))})
    last = F.col("_under") + F.col("_last")
    ranks = [F.expr("(_all + 1) div 2"), F.expr("_all div 2 + 1")]
    middle = [F.max(F.when(F.col("_at").isNotNull() & (last - F.col("_n") < rank) & (last >= rank), F.col("_at"))) for rank in ranks]
    spread = F.sum(F.col("_n") * (F.col("_var") + (F.col("_mean") - F.col("_center")) * (F.col("_mean") - F.col("_center"))))
    total = F.sum("_n")
    return parts.groupBy(key).agg(
        F.coalesce(F.sum("_sum"), F.lit(0.0)).alias("sum"), F.max("_center").alias("mean"), F.min("_min").alias("min"), F.max("_max").alias("max"),
        total.alias("count"), F.sqrt(spread / F.nullif(total - 1, F.lit(0))).alias("std"), ((middle[0] + middle[1]) / 2).alias("median"))


def summary_two_level(df: DataFrame, main: str, sub: str, column: str) -> DataFrame:
    return sum_by(df, [main, sub], [column])


def summary_grouping_sets(df: DataFrame, main: str, sub: str, column: str) -> DataFrame:
    """Both single-level sums and the two-level sum from one pass over the table."""
    rows = _known(df, [main, sub])
    sets = [[F.col(main), F.col(sub)], [F.col(main)], [F.col(sub)]]
    return rows.groupingSets(sets, F.col(main), F.col(sub)).agg(
        F.coalesce(F.sum(column), F.lit(0.0)).alias(column),
        F.grouping(main).cast("int").alias("all_" + main), F.grouping(sub).cast("int").alias("all_" + sub))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def abs_maxima(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.max(F.abs(c)).alias(c) for c in columns])


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def subset_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition).agg(F.count("*").alias("n"))


def coverage_ratio(df: DataFrame, key: str, entity, other) -> DataFrame:
    """Row count of one entity over that of another; null if the other has none."""
    both = df.agg(F.count_if(F.col(key) == F.lit(entity)).alias("n"), F.count_if(F.col(key) == F.lit(other)).alias("m"))
    return both.select(F.try_divide("n", "m").alias("ratio"))


def first_observed(df: DataFrame, s: Series, column: str) -> DataFrame:
    """First time each entity has a value, numbered in that order (then by name)."""
    (key,) = s.keys
    first = df.filter(F.col(column).isNotNull()).groupBy(key).agg(F.min(s.time).alias("first_time"))
    return global_rank(first, ["first_time", key], "ordinal")


def random_series(df: DataFrame, key: str, time: str, columns: Sequence[str], seed: int) -> DataFrame:
    """One entity and one measure picked by a seed, as a series in time order.

    The pick is the smallest hash of seed and name, the same on every engine and run.
    """
    measure = min(columns, key=lambda c: hashlib.md5(f"{seed}{c}".encode()).hexdigest())
    picked = df.select(key).distinct().agg(F.min_by(key, F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string"))))).scalar()
    chosen = df.filter(F.col(key) == picked)
    return chosen.select(key, time, F.lit(measure).alias("measure"), F.col(measure).alias("value")).orderBy(time)
