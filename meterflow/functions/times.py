"""Session-zone independent time arithmetic on TIMESTAMP_NTZ columns."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts(value) -> Column:
    """A TIMESTAMP_NTZ literal, so comparisons reach the Parquet scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_micros(c: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", ts("1970-01-01 00:00:00"), _col(c).cast("timestamp_ntz"))


def day_of(c: Column | str) -> Column:
    """Midnight of the row's day. ``date_trunc`` would go through the session zone."""
    return _col(c).cast("date").cast("timestamp_ntz")


def hour_of(c: Column | str) -> Column:
    c = _col(c)
    return day_of(c) + F.make_dt_interval(hours=F.hour(c))


def month_of(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def local_to_utc(c: Column | str, zone: str = "Europe/Copenhagen") -> Column:
    """Wall-clock time in ``zone`` to UTC; a repeated autumn hour takes the earlier instant (see ``operators.windows.local_to_utc_in_order``)."""
    shifted = F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(c).cast("timestamp_ntz"))
    return shifted.cast("timestamp_ntz")
