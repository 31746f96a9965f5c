"""Ordered operators over series: positions, gaps, lags, running extremes, latest rows."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import local_to_utc
from .fill import _names, next_known
from .joins import join_dimension
from .layout import (CHUNK, COUNT, HOME, INDEX, SO_FAR, Series, by_time_chunk, chunk_table, ends, join_state, no_gaps, spread,
                     with_halo, with_index, with_position)


def series_position(df: DataFrame, s: Series, name: str = "position", tie: Sequence[str] = ()) -> DataFrame:
    """0-based place of each row in its series."""
    return with_position(df, s, name, tie)


def find_gaps(df: DataFrame, s: Series, column: str) -> DataFrame:
    """Maximal runs of missing values, one row each.

    The missing rows of one run share the number of values observed before them, so
    runs are found by counting, and a run of any length is reduced map-side.
    """
    chunked = by_time_chunk(df.select(*s.keys, s.time, column), s)
    state = chunk_table(chunked, s, F.count(column).alias("_seen")).select(
        *s.keys, CHUNK,
        F.coalesce(F.sum(COUNT).over(s.earlier()), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_seen").over(s.earlier()), F.lit(0)).alias("_seen_before"))
    rows = spread(chunked, s).withColumns({
        "_row": F.row_number().over(s.local()),
        "_seen_here": F.count(column).over(s.local().rowsBetween(*SO_FAR)),
    }).filter(F.col(column).isNull())
    rows = join_state(rows, state, s).select(
        *s.keys, s.time,
        (F.col("_rows_before") + F.col("_row") - 1).alias("_position"),
        (F.col("_seen_before") + F.col("_seen_here")).alias("_run"))
    runs = rows.groupBy(*s.keys, "_run").agg(
        F.min(s.time).alias("start_time"), F.max(s.time).alias("end_time"),
        F.count("*").alias("gap_length_records"),
        F.min("_position").alias("start_index"), F.max("_position").alias("end_index"))
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return runs.select(
        *s.keys, "start_time", "end_time",
        (F.col("end_time") - F.col("start_time")).alias("duration"),
        (seconds / F.lit(86400.0)).alias("duration_days"),
        "gap_length_records", "start_index", "end_index")


def gap_summary(df: DataFrame, s: Series, column: str) -> DataFrame:
    """Longest and mean gap of every series that has one."""
    return find_gaps(df, s, column).groupBy(*s.keys).agg(
        F.count("*").alias("gaps"),
        F.max("gap_length_records").alias("max_gap"),
        F.avg("gap_length_records").alias("mean_gap"))


def lag_backfill(df: DataFrame, s: Series, column: str, lag: int, name: str = "lagged") -> DataFrame:
    """Shift a series ``lag`` rows later, then back-fill; lag 0 leaves it as it is."""
    if lag == 0:
        return df.withColumn(name, F.col(column))
    indexed = with_index(df, s)
    # Where each value lands after the shift; values pushed past the end are gone.
    landing = indexed.select(*s.keys, INDEX, column).withColumn("_at", F.col(INDEX) + lag)
    landing = landing.withColumn(CHUNK, s.chunk_of(F.col("_at")))
    known = F.col(column).isNotNull()
    summary = landing.groupBy(*s.keys, CHUNK).agg(
        next_known(column, "_at").alias("_value"), F.min(F.when(known, F.col("_at"))).alias("_first_at"),
        F.max(INDEX).alias("_end"))
    end = F.max("_end").over(Window.partitionBy(*s.keys))
    summary = summary.withColumn("_series_end", end)
    reachable = F.when(F.col("_first_at") <= F.col("_series_end"), F.col("_value"))
    # A chunk of the table need not be one that values land in (the first), so look up by
    # chunk number over both.
    chunks = no_gaps(chunk_table(indexed.withColumn(CHUNK, s.chunk_of(F.col(INDEX))), s, *ends(s)), s).select(*s.keys, CHUNK, F.lit(1).alias("_own"))
    state = chunks.join(summary.select(*s.keys, CHUNK, reachable.alias("_value")), [*s.keys, CHUNK], "full")
    state = state.withColumn("_after", F.last("_value", ignorenulls=True).over(s.later()))
    state = state.filter("_own = 1").select(*s.keys, CHUNK, "_after")

    rows = with_halo(indexed, s, lag).withColumn("_shifted", F.lag(column, lag).over(s.local(INDEX)))
    rows = rows.withColumn("_filled", F.coalesce(F.col("_shifted"), s.next_value("_shifted", INDEX)))
    rows = join_state(rows.filter(HOME), state, s)
    return rows.withColumn(name, F.coalesce("_filled", "_after")).select(*df.columns, name)


def running_abs_max(df: DataFrame, s: Series, columns: str | Sequence[str], prefix: str = "max_") -> DataFrame:
    """Largest absolute value so far, at every time at once."""
    cols = _names(columns)
    chunked = by_time_chunk(df, s)
    state = chunk_table(chunked, s, *[F.max(F.abs(c)).alias(f"_{c}") for c in cols]).select(
        *s.keys, CHUNK, *[F.max(f"_{c}").over(s.earlier()).alias(f"_before_{c}") for c in cols])
    here = s.local().rowsBetween(*SO_FAR)
    rows = join_state(spread(chunked, s).withColumns({f"_here_{c}": F.max(F.abs(c)).over(here) for c in cols}), state, s)
    return rows.withColumns({prefix + c: F.greatest(f"_here_{c}", f"_before_{c}") for c in cols}).select(
        *df.columns, *[prefix + c for c in cols])


def minmax_by_time(df: DataFrame, time: str, column: str, name: str = "normalized") -> DataFrame:
    """Scale a column to 0..1 across all entities at the same time; null where all are equal."""
    bounds = df.groupBy(time).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    spread_out = F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    rows = join_dimension(df, bounds, time, time, ["_low", "_high"], how="left")
    return rows.withColumn(name, (F.col(column) - F.col("_low")) / spread_out).drop("_low", "_high")


def latest_row(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The last row of every series; of several at that time, the largest by its columns in their order."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(time, *rest)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def dedupe_first(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str]) -> DataFrame:
    """One row per (keys, time): the first by ``tie``. Reduced map-side, so copies never gather."""
    rest = [c for c in df.columns if c not in (*keys, time)]
    first = F.min_by(F.struct(*rest), F.struct(*tie)).alias("_first")
    return df.groupBy(*keys, time).agg(first).select(*keys, time, "_first.*").select(*df.columns)


def local_to_utc_in_order(df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], zone: str = "Europe/Copenhagen",
                          name: str = "utc", repeat: timedelta = timedelta(hours=1)) -> DataFrame:
    """Wall-clock times of series to UTC, the pass of a repeated autumn hour found from the order of the rows.

    Within one such hour of a series, the clock going back (or standing still) from one row to the next starts the second pass. Without such
    a step the rows are taken for the first, the earlier instant. ``repeat`` is how far the zone's clock goes back. Only rows
    in a repeated hour are ordered, by series and hour; all others are converted where they are. Rows without a time or order keep that.
    """
    first = local_to_utc(time, zone)
    second = first + F.make_dt_interval(secs=F.lit(repeat.total_seconds()))
    again = F.convert_timezone(F.lit("UTC"), F.lit(zone), second).cast("timestamp_ntz") == F.col(time).cast("timestamp_ntz")
    marked = df.withColumns({"_first": first, "_again": F.coalesce(again, F.lit(False))})
    once = marked.filter("not _again").select(*df.columns, F.col("_first").alias(name))
    hour = Window.partitionBy(*keys, F.to_date("_first")).orderBy(*order)
    back = F.coalesce((F.col(time) <= F.lag(time).over(hour)).cast("int"), F.lit(0))
    steps = marked.filter("_again").withColumn("_back", back).withColumn("_passed", F.max("_back").over(hour.rowsBetween(*SO_FAR)))
    shift = F.when(F.col("_passed") > 0, F.lit(repeat.total_seconds())).otherwise(F.lit(0.0))
    return once.unionAll(steps.select(*df.columns, (F.col("_first") + F.make_dt_interval(secs=shift)).alias(name)))
