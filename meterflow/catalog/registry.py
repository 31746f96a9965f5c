"""Pairs of a Spark query and the SQL text that must give the same rows."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BUILDS: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of the tables under ``name``."""
    def add(build: Callable[[Tables], DataFrame]):
        BUILDS[name] = build
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLE[name] = oracle
        return build
    return add


def by_user(*names: str) -> None:
    """Register queries over ``series`` once more, with every user as an entity."""
    for name in names:
        build = BUILDS[name]
        QUERIES[f"user_{name}"] = lambda spark, folder, build=build: build(Tables(spark, folder, by_user=True))
        ORACLE[f"user_{name}"] = ORACLE[name].replace("least(user_id % 8, 3)", "user_id")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Engines add doubles in different orders: compare to ``digits`` places.

    A mean of two-decimal values often ends in an exact 5 there, so all are moved off
    such ties by 1e-9 before rounding; adding 0.0 clears a negative zero.
    """
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) + F.lit(0.0) for c in columns})


def r(c: str, digits: int = 6) -> str:
    return f"round({c} + 1e-9, {digits}) + 0.0 as {c}"
