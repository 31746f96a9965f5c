"""Row filters. All are plain comparisons, so they reach the Parquet scan."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import ts
from .layout import Series, floor_div, with_position


SLOTS = 65_536


def time_range(df: DataFrame, time: str, start, end, offset: int = 0, ties: Sequence[str] = ()) -> DataFrame:
    """Rows from start up to but not including end; ``offset`` leaves out the first rows by (time, ties).

    The time of the row behind the offset is found by counting: rows per slot of the range, then per slot of the slot that holds
    it, down to microseconds. These are small jobs, each over one slot of the last, with at most ``SLOTS`` counts. Later rows then
    stay by a comparison that reaches the scan, and only rows at that very time are numbered, by their ties. An offset
    past the last row leaves nothing.
    """
    rows = df.filter((F.col(time) >= ts(start)) & (F.col(time) < ts(end)))
    if not offset:
        return rows
    micro = timedelta(microseconds=1)
    low, width, rank = _time(start), max(_time(end) - _time(start), micro), offset
    while width > micro:
        step = timedelta(microseconds=-(-(width // micro) // SLOTS))
        slot = floor_div(F.timestamp_diff("MICROSECOND", ts(low), F.col(time)), step // micro)
        counts = rows.filter((F.col(time) >= ts(low)) & (F.col(time) < ts(low + width))).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("slot")))
        found = upto.filter((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)).first()
        if found is None:
            return rows.filter(F.lit(False))
        low, rank, width = low + found["slot"] * step, rank - found["upto"] + found["n"], step
    placed = with_position(rows.filter(F.col(time) == ts(low)), Series((), time, chunk=1), "_place", [*ties] or [time])
    return rows.filter(F.col(time) > ts(low)).unionAll(placed.filter(F.col("_place") >= rank).select(*df.columns))


def _time(value) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(str(value))


def up_to(df: DataFrame, time: str, t) -> DataFrame:
    return df.filter(F.col(time) <= ts(t))


def since(df: DataFrame, time: str, t) -> DataFrame:
    return df.filter(F.col(time) >= ts(t))


def at_time(df: DataFrame, time: str, t) -> DataFrame:
    return df.filter(F.col(time) == ts(t))


def of_entity(df: DataFrame, **values) -> DataFrame:
    for column, value in values.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def among(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def observed(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def where(df: DataFrame, predicate: str, values: Mapping[str, object] | None = None) -> DataFrame:
    """Filter by an expression string; ``{name}`` marks a value, bound as a literal and never pasted."""
    if not values:
        return df.filter(predicate)
    bound = {name: F.lit(value) for name, value in values.items()}
    keep = list(df.columns)
    marked = df.withColumns({f"_{name}": value for name, value in bound.items()})
    return marked.filter(predicate.format(**{name: f"_{name}" for name in bound})).select(*keep)


def display_window(df: DataFrame, time: str, cutoff, weeks_before: int = 1, months_after: int = 2) -> DataFrame:
    """A week before the cutoff to some months after it, both ends included."""
    start = ts(cutoff) - F.make_dt_interval(days=F.lit(7 * weeks_before))
    end = ts(cutoff) + F.make_ym_interval(months=F.lit(months_after))
    return df.filter((F.col(time) >= start) & (F.col(time) <= end))
