"""Joins of facts with dimensions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SALTS = 32


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: Sequence[str], how: str = "inner",
                   hot_share: float | None = None, salts: int = SALTS) -> DataFrame:
    """Join a fact table with a dimension that adds ``columns`` (facts without a match are dropped, or kept with "left").

    A plain equi-join: adaptive execution picks the strategy by measured bytes and splits skewed partitions. With
    ``hot_share``, keys that hold at least that share of the facts are found by a count that is combined before its shuffle;
    their facts alone are dealt over ``salts`` tasks, and their rows of the dimension alone are copied. There
    are at most 1 / ``hot_share`` such keys, so they are broadcast. The salt is a hash of the row and of the
    partition it lies in: equal rows are dealt out too, and a retried task deals as before.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"), *columns)
    if hot_share is None:
        return fact.join(side, fact[fact_key] == side["_dim_key"], how).drop("_dim_key")
    counts = fact.groupBy(F.col(fact_key).alias("_hot_key")).agg(F.count("*").alias("_n"))
    total = fact.agg(F.count("*").alias("n")).scalar()
    hot = F.broadcast(counts.where((F.col("_n") >= total * hot_share) & F.col("_hot_key").isNotNull()).select("_hot_key"))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *fact.columns), F.lit(salts)).cast("int")
    salted = fact.withColumn("_spread", spread).join(hot, F.col(fact_key) == F.col("_hot_key"), "left")
    salted = salted.withColumn("_salt", F.when(F.col("_hot_key").isNotNull(), F.col("_spread")).otherwise(0))
    copied = side.join(hot.withColumnRenamed("_hot_key", "_hot_dim"), F.col("_dim_key") == F.col("_hot_dim"), "left")
    copies = copied.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.when(F.col("_hot_dim").isNotNull(), salts - 1).otherwise(0))))
    joined = salted.join(copies, (F.col(fact_key) == F.col("_dim_key")) & (F.col("_salt") == F.col("_copy")), how)
    return joined.select(*[salted[c] for c in fact.columns], *columns)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the values of a one-row table next to every row, as scalar subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})
