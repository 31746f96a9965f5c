"""Small column expressions shared by the operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .times import _col


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks a missing value at the sources; Spark's aggregates only skip NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def sqrt_or_null(c: Column | str) -> Column:
    """Square root; negative input gives NULL (NaN in Spark would spread)."""
    c = _col(c)
    return F.when(c >= 0, F.sqrt(c))


def truncate_whole(c: Column | str) -> Column:
    """Drop the fraction (toward zero) but stay DOUBLE, keeping missing values."""
    return _col(c).cast("bigint").cast("double")


def direction(c: Column | str) -> Column:
    """Signed exchange to a label: zero and above leave the country."""
    return F.when(_col(c) >= 0, "Export").otherwise("Import")


def one_decimal(c: Column | str) -> Column:
    """A non-negative number with one decimal, rounded on its binary value, ties to even (as ``%.1f`` in C).

    ``format_string`` alone rounds the shortest decimal text instead (0.15 to 0.2). Near a
    tie both subtractions below are exact, so the sign of ``beyond`` is.
    """
    c = _col(c)
    part = c - F.floor(c)
    tenth = F.floor(part * 10)
    beyond = (part * 16 - (tenth * 2 + 1)) + part * 4
    up = F.when(beyond > 0, 1).when(beyond < 0, 0).otherwise(F.pmod(tenth, F.lit(2)))
    return F.format_string("%.1f", (F.floor(c) * 10 + tenth + up) / F.lit(10.0))


def megawatt_label(prefix: Column | str, amount: Column | str) -> Column:
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.format_string("%s: %s MWh", prefix, one_decimal(amount))


def row_id(*key_columns: str) -> Column:
    """A row id: random UUID, or a digest of ``key_columns`` that a retry repeats."""
    if not key_columns:
        return F.uuid()
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key_columns]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
