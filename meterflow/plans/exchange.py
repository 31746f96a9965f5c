"""How much of each cross-border connection is in use."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import direction, megawatt_label
from ..operators.aggregates import sum_by
from ..operators.filters import at_time
from ..operators.layout import Series
from ..operators.windows import running_abs_max

# Country, exchange column, city shown, latitude, longitude.
COUNTRIES = (
    ("Norway", "exchangeno_mwh", "Oslo", 59.9139, 10.7522),
    ("Sweden", "exchangese_mwh", "Stockholm", 59.3327, 18.0656),
    ("Netherlands", "exchangenl_mwh", "Amsterdam", 52.3676, 4.9041),
    ("Germany", "exchangege_mwh", "Berlin", 52.5200, 13.4050),
    ("Denmark", None, "Copenhagen", 55.6761, 12.5683),
    ("Great Britain", None, "London", 51.5072, 0.1276),
)


def country_dim(spark: SparkSession) -> DataFrame:
    """The six countries: exchange column (none for the static two), city and coordinates."""
    return spark.createDataFrame(list(COUNTRIES), "country string, measure string, city string, lat double, lon double")


def exchange_by_hour(settlement: DataFrame, time: str, columns) -> DataFrame:
    return sum_by(settlement, [time], list(columns))


def _per_country(row: DataFrame, columns: Mapping[str, str], keep: list[str], fields) -> DataFrame:
    entries = [F.struct(F.lit(country).alias("country"), *fields(c)) for country, c in columns.items()]
    return row.select(*keep, F.explode(F.array(*entries)).alias("_e")).select(*keep, "_e.*")


def exchange_utilisation(settlement: DataFrame, time: str, columns: Mapping[str, str]) -> DataFrame:
    """Per hour and country: exchange, capacity (largest so far), what is left of it, direction and use.

    ``columns`` maps a country to its exchange column. Every hour is answered at once;
    filter the result for one point in time.
    """
    hourly = exchange_by_hour(settlement, time, columns.values())
    capacity = running_abs_max(hourly, Series((), time), list(columns.values()))

    def fields(c: str) -> list[Column]:
        return [F.col(c).alias("exchange"), F.col("max_" + c).alias("capacity")]

    rows = _per_country(capacity, columns, [time], fields)
    used = F.abs("exchange")
    return rows.select(
        time, "country", "exchange", "capacity", used.alias("used"), (F.col("capacity") - used).alias("remaining"),
        direction("exchange").alias("direction"), F.try_divide(used, F.col("capacity")).alias("utilisation"))


def exchange_map(settlement: DataFrame, time: str, t, columns: Mapping[str, str]) -> DataFrame:
    """Every country with its city and coordinates, and its connection at one time; the static ones have none."""
    used = at_time(exchange_utilisation(settlement, time, columns), time, t)
    return country_dim(settlement.sparkSession).drop("measure").join(used, "country", "left")


def exchange_labels(utilisation: DataFrame) -> DataFrame:
    return utilisation.withColumns({
        "used_label": megawatt_label(F.col("direction"), "used"),
        "unused_label": megawatt_label("Unused", "remaining")})
