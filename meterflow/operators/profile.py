"""Profiles of missing values."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _missing(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _unpivot(counts: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("num")) for c in columns])).alias("_e")
    return counts.select(*keys, "_rows", entries).select(*keys, "_rows", "_e.column", "_e.num")


def missing_profile(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values: how many and which fraction, most first (per entity if keyed)."""
    columns = [c for c in (columns or df.columns) if c not in keys]
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *[_missing(c).alias(c) for c in columns])
    profile = _unpivot(counts, keys, columns).filter("num > 0")
    profile = profile.select(*keys, "column", "num", (F.col("num") / F.col("_rows")).alias("pct"))
    return profile.orderBy(*keys, F.desc("num"), "column")


def missing_pct_by_entity(df: DataFrame, key: str, column: str, above: float = 0.0, below: float | None = None) -> DataFrame:
    """Percent missing per entity, highest first; entities outside (above, below) are left out."""
    pct = df.filter(F.col(key).isNotNull()).groupBy(key).agg((_missing(column) * 100 / F.count("*")).alias("pct"))
    pct = pct.filter(F.col("pct") > above)
    if below is not None:
        pct = pct.filter(F.col("pct") < below)
    return pct.orderBy(F.desc("pct"), key)


def missing_pct_matrix(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Percent missing per entity and column from one pass; zeroes are left out."""
    known = df.filter(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count("*").alias("_rows"), *[_missing(c).alias(c) for c in columns])
    pct = _unpivot(counts, [key], columns).select(key, "column", (F.col("num") * 100 / F.col("_rows")).alias("pct"))
    return pct.filter("pct > 0").orderBy("column", F.desc("pct"), key)


def entities_with_missing(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull()).select(key).distinct()


def entities_observed(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(key).distinct()
