"""The dashboard's frames: map slice, line view, table load."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import nan_to_null, sqrt_or_null
from ..operators.filters import at_time, of_entity, up_to
from ..operators.joins import join_dimension
from ..operators.layout import Series
from ..operators.schema import cast_columns, rename_columns, sort_by_time
from ..operators.spectral import dct_smooth
from ..operators.windows import latest_row, minmax_by_time
from ..sources import schemas
from ..sources.tables import read_documents, read_table

# Marker size per table kind; the first is scaled 0..1, the others by square root.
MARKER_SIZE = {"weather": 15.0, "consumption": 0.05, "production": 3.0}


def map_slice(df: DataFrame, time: str, t, entity: str, measure: str, kind: str, areas: DataFrame, area_key: str,
              **only) -> DataFrame:
    """One measure of every entity at one time, with marker size and coordinates."""
    rows = of_entity(at_time(df, time, t), **only).select(time, entity, F.col(measure).alias("value"))
    if kind == "weather":
        rows = minmax_by_time(rows, time, "value", "scaled")
    else:
        rows = rows.withColumn("scaled", sqrt_or_null("value"))
    rows = rows.withColumn("marker", F.col("scaled") * F.lit(MARKER_SIZE[kind]))
    return join_dimension(rows, areas, entity, area_key, ["lat", "lon"]).orderBy(entity)


def line_view(df: DataFrame, s: Series, t, measure: str, max_val: int = 10, **entity) -> DataFrame:
    """One series up to a time: observed, smoothed, and whether it is the latest point.

    ``entity`` names the series by all its keys (and may narrow it, as by branch).
    """
    unnamed = [k for k in s.keys if k not in entity]
    if unnamed:
        raise ValueError(f"a line view shows one series: give {unnamed}")
    rows = of_entity(up_to(df, s.time, t), **entity).select(*s.keys, s.time, measure)
    smooth = dct_smooth(rows, s.over(keys=()), measure, max_val).withColumnRenamed(measure + "_smooth", "smoothed_signal")
    return smooth.withColumn("is_latest", F.col(s.time) == rows.agg(F.max(s.time)).scalar())


def latest_point(df: DataFrame, s: Series, t) -> DataFrame:
    """The row a line view marks, for every series at once."""
    return latest_row(up_to(df, s.time, t), list(s.keys), s.time)


def dashboard_load(tables: Mapping[str, DataFrame], order: Mapping[str, Sequence[str]], measures: Mapping[str, list[str]],
                   names: Mapping[str, Mapping[str, str]]) -> dict[str, DataFrame]:
    """All tables renamed, with their measures as numbers, sorted. Nothing is read until a frame is used."""
    loaded = {}
    for name, df in tables.items():
        df = rename_columns(df, names.get(name, {}))
        df = nan_to_null(cast_columns(df, {c: "double" for c in measures.get(name, [])}))
        loaded[name] = sort_by_time(df, *order[name])
    return loaded


def dashboard_tables(spark: SparkSession, base: str, namespace: str, enriched: bool = True) -> dict[str, DataFrame]:
    """The six stored tables as the dashboard uses them, each read only when a frame is used.

    ``enriched`` production and consumption carry the area name.
    """
    tables = {}
    for name, fields in schemas.STORED.items():
        if name in schemas.DOCUMENTS:
            tables[name] = read_documents(spark, base, name, namespace, fields)
        else:
            named = enriched and name in ("production", "consumption")
            tables[name] = read_table(spark, base, name, namespace, fields + (", municipality string" if named else ""))
    order = {"municipalities": ["municipality"], "gas": ["gasday"], "production": ["hourutc", "municipalityno"],
             "consumption": ["hourutc", "municipalityno", "branche"], "prodcons": ["hourutc", "pricearea"],
             "weather": ["hourutc", "municipality"]}
    return dashboard_load(tables, order, {"weather": list(schemas.WEATHER_MEASURES)}, {"weather": {"time": "hourutc"}})
