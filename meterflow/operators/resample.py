"""Regular calendars and bucketed means."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.times import day_of, epoch_micros
from .layout import CHUNK, Series, by_time_chunk, floor_div, join_state, spread


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def _interval(s: Series) -> Column:
    return F.make_dt_interval(secs=F.lit(s.step.total_seconds()))


def calendar(entities: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Every hour from first to last for each row of ``entities`` (days first, to keep arrays short).

    The days are dealt out under a set number of partitions: adaptive execution would
    fold the short list of entities into one task, which the calendar then multiplies.
    """
    spark = entities.sparkSession
    day = F.explode(F.sequence(day_of(first), day_of(last), F.make_dt_interval(days=F.lit(1)))).alias("_day")
    days = entities.select("*", first.alias("_first"), last.alias("_last")).select("*", day)
    days = days.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *entities.columns, "_day")
    hour = F.explode(F.sequence(F.col("_day"), F.col("_day") + F.make_dt_interval(hours=F.lit(23)), F.make_dt_interval(hours=F.lit(1))))
    hours = days.withColumn(name, hour)
    return hours.filter(F.col(name).between(F.col("_first"), F.col("_last"))).drop("_day", "_first", "_last")


def on_calendar(measured: DataFrame, entities: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Every hour from first to last for each row of ``entities``, with what was measured in it.

    ``measured`` has at most one row per entity and hour. Its rows meet the calendar as days, each with its hours as a map, so
    hours are neither shuffled nor sorted.
    """
    spark, keys = entities.sparkSession, entities.columns
    values = [c for c in measured.columns if c not in (*keys, name)]
    by_day = measured.groupBy(*keys, day_of(name).alias("_day")).agg(F.map_from_entries(F.collect_list(F.struct(F.col(name), F.struct(*values)))).alias("_hours"))
    days = entities.select("*", first.alias("_first"), last.alias("_last")).select("*", F.explode(F.sequence(
        day_of("_first"), day_of("_last"), F.make_dt_interval(days=F.lit(1)))).alias("_day"))
    days = days.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "_day").join(by_day, [*keys, "_day"], "left")
    hour = F.explode(F.sequence(F.col("_day"), F.col("_day") + F.make_dt_interval(hours=F.lit(23)), F.make_dt_interval(hours=F.lit(1))))
    hours = days.withColumn(name, hour).filter(F.col(name).between(F.col("_first"), F.col("_last"))).withColumn("_row", F.col("_hours")[F.col(name)])
    return hours.select(*keys, name, *[F.col("_row")[c].alias(c) for c in values])


def date_range(first: Column, last: Column, source: DataFrame, name: str = "dt") -> DataFrame:
    """Every day from first to last, one row each, for each row of ``source``."""
    return source.select("*", F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))


def asfreq_ffill(df: DataFrame, s: Series) -> DataFrame:
    """Put each series on the regular grid that starts at its first time; a grid point has the last row up to it.

    A row owns the grid points from its time to the next row's, found by whole division, so no calendar has to
    be joined. A long hole is opened in stretches first, so that no array holds more than ``Series.chunk`` points.
    """
    micros = s.step // timedelta(microseconds=1)
    chunked = by_time_chunk(df, s)
    state = chunked.groupBy(*s.keys, CHUNK).agg(F.min(s.time).alias("_least")).select(
        *s.keys, CHUNK, F.last("_least").over(s.later()).alias("_after"), F.min("_least").over(Window.partitionBy(*s.keys)).alias("_first"))
    rows = join_state(spread(chunked, s).withColumn("_next", F.lead(s.time).over(s.local())), state, s)
    until = F.coalesce(F.col("_next"), F.col("_after"))

    def points_before(time: Column) -> Column:
        return floor_div(epoch_micros(time) - epoch_micros(F.col("_first")) + F.lit(micros - 1), micros)

    low = points_before(F.col(s.time))
    on_grid = epoch_micros(F.col("_first")) + low * micros == epoch_micros(F.col(s.time))
    high = F.when(until.isNotNull(), points_before(until) - 1).otherwise(F.when(on_grid, low).otherwise(low - 1))
    owned = rows.withColumns({"_low": low, "_high": high}).filter("_low <= _high")
    parts = owned.withColumn("_part", F.explode(F.sequence(F.col("_low"), F.col("_high"), F.lit(s.chunk).cast("bigint"))))
    points = parts.withColumn("_point", F.explode(F.sequence(F.col("_part"), F.least(F.col("_part") + s.chunk - 1, F.col("_high")))))
    time = F.col("_first") + F.col("_point") * _interval(s)
    return points.select(*[time.alias(c) if c == s.time else F.col(c) for c in df.columns])


def daily_resample(df: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str], name: str = "dt",
                   how: str = "mean") -> DataFrame:
    """Daily mean (or sum) per series on a complete calendar: an empty day has mean null, sum 0."""
    reduce = {"mean": F.avg, "sum": F.sum}[how]
    daily = df.groupBy(*keys, F.col(time).cast("date").alias(name)).agg(*[reduce(c).alias(c) for c in columns])
    # One row per (keys, day) is left: the window sees days, not rows.
    daily = daily.withColumn("_ahead", F.lead(name).over(Window.partitionBy(*keys).orderBy(name)))
    until = F.coalesce(F.date_sub("_ahead", 1), F.col(name))
    stretched = daily.withColumn("_day", F.explode(F.sequence(F.col(name), until, F.expr("interval 1 day"))))
    present = F.col("_day") == F.col(name)
    empty = F.lit(0.0) if how == "sum" else F.lit(None)
    values = [F.when(present, F.coalesce(F.col(c), F.lit(0.0)) if how == "sum" else F.col(c)).otherwise(empty).alias(c) for c in columns]
    return stretched.select(*keys, F.col("_day").alias(name), *values)


def daily_mean_by_entity(df: DataFrame, key: str, time: str, name: str = "dt") -> DataFrame:
    """Daily mean of every numeric column, per entity, on a complete calendar."""
    return daily_resample(df, [key], time, numeric_columns(df, [key, time]), name)
