"""Price against wind: daily pairing and sliding correlation."""
from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import nan_to_null
from ..operators.correlate import align_series, clip_to_range, sliding_corr
from ..operators.filters import of_entity
from ..operators.layout import Series
from ..operators.resample import daily_mean_by_entity, daily_resample
from ..operators.spectral import dct_smooth
from ..operators.windows import lag_backfill
from ..sources.storage import settled

DAILY = Series((), "dt", step=timedelta(days=1))


def sync_daily(weather: DataFrame, price: DataFrame, time_weather: str, time_price: str, prop: str, price_col: str,
               entity_col: str, entity, accum: str = "mean") -> DataFrame:
    """One entity's weather beside the daily price. Without the daily mean only midnight rows meet a price."""
    rows = nan_to_null(of_entity(weather, **{entity_col: entity}).select(entity_col, time_weather, prop))
    if accum == "mean":
        rows = daily_mean_by_entity(rows, entity_col, time_weather, "dt").select("dt", prop)
    else:
        at_midnight = F.col(time_weather) == F.col(time_weather).cast("date").cast("timestamp_ntz")
        rows = rows.filter(at_midnight).select(F.col(time_weather).cast("date").alias("dt"), prop)
    price = price.select(F.col(time_price).cast("date").alias("dt"), price_col)
    return rows.join(price, "dt")


def price_wind_corr(price: DataFrame, price_time: str, price_col: str, weather: DataFrame, time: str, wind: str,
                    swc_width: int = 7, lag: int = 0, dct_filter: bool = False, dct_cutoff: int = 0) -> DataFrame:
    """Sliding correlation of the daily price with the daily mean wind of all entities.

    The wind is clipped to the price's days, then lagged, then both are smoothed, in
    this order. Days are matched by date, also when smoothing. The raw tables are read
    once; everything after runs on the stored days.
    """
    prices = price.select(F.col(price_time).cast("date").alias("dt"), F.col(price_col).alias("price"))
    prices = settled(prices, "daily-price")
    winds = settled(daily_resample(weather, [], time, [wind]).withColumnRenamed(wind, "wind"), "daily-wind")
    # A clipped calendar has no holes, unlike the union of both sides' days below.
    winds = lag_backfill(clip_to_range(winds, "dt", prices, "dt"), DAILY.over(regular=True), "wind", lag, "wind_used").drop("wind")
    if dct_filter:
        prices = dct_smooth(prices, DAILY, "price", dct_cutoff).drop("price").withColumnRenamed("price_smooth", "price")
        winds = dct_smooth(winds, DAILY, "wind_used", dct_cutoff).drop("wind_used").withColumnRenamed("wind_used_smooth", "wind_used")
    both = align_series(prices, winds, ["dt"])
    return sliding_corr(both, DAILY, "price", "wind_used", swc_width)
