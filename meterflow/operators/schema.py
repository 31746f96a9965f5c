"""Column-level reshaping: renames, casts, migrations."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import truncate_whole


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def lowercase_columns(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    clashes = sorted({c for c in lowered if lowered.count(c) > 1})
    if clashes:
        raise ValueError(f"columns differ only by case: {clashes}")
    return df.toDF(*lowered)


def parse_timestamps(df: DataFrame, columns: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Text to TIMESTAMP_NTZ; text that is no time raises."""
    args = [F.lit(fmt)] if fmt else []
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c), *args) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns. Strict raises on a value that does not fit, otherwise it becomes null."""
    return df.withColumns({c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()})


def truncate_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: truncate_whole(c) for c in columns})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def migrate_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Add a column, copy the old one's values into it, drop the old one."""
    return df.withColumn(new, F.col(old)).drop(old)


def measure_columns(df: DataFrame, exclude: Sequence[str], ordered: bool = False) -> list[str]:
    """Every column but the excluded ones (keys, times, ids)."""
    names = [c for c in df.columns if c not in exclude]
    return sorted(names) if ordered else names


def sort_by_time(df: DataFrame, time: str, *ties: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (time, *ties)])


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    return sort_by_time(df, *order).limit(n)
