"""Landed files to typed tables, and tables enriched with area names."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null
from ..operators.joins import join_dimension
from ..operators.schema import cast_columns, lowercase_columns, parse_timestamps, rename_columns, sort_by_time
from ..sources import schemas
from ..sources.html import extract_html_table
from ..sources.records import read_records
from ..sources.tables import insert_documents, overwrite_table, read_table, typed_columns, write_table

def clean_records(raw: DataFrame, times: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """Lower-case names, parse times, cast the named columns, NaN to null."""
    return nan_to_null(cast_columns(parse_timestamps(lowercase_columns(raw), times), types))


def ingest_records(spark: SparkSession, path: str, schema: T.StructType | str, times: Sequence[str],
                   types: Mapping[str, str], per_line: bool = False) -> DataFrame:
    """Payload files to a cleaned table. Field names match in any case; the columns are lower-case."""
    return clean_records(read_records(spark, path, schema, per_line, any_case=True), times, types)


def ingest_all(spark: SparkSession, landing: str, area_pages: DataFrame, base: str, namespace: str) -> None:
    """Landed payloads (one folder per dataset) and the area page to cleaned, typed, stored tables.

    ``area_pages`` needs an ``html`` column.
    """
    for name, (fields, times, types) in schemas.PAYLOADS.items():
        rows = ingest_records(spark, f"{landing.rstrip('/')}/{name}", fields, times, types)
        if name in schemas.DOCUMENTS:
            insert_documents(rows, base, name, namespace)
        else:
            write_table(typed_columns(rows), base, name, namespace)
    found = extract_html_table(area_pages, "html", schemas.AREA_TABLE_CLASS, T.StructType.fromDDL(schemas.AREA_PAGE))
    insert_documents(rename_columns(found, schemas.AREA_NAMES), base, "municipalities", namespace)


def enrich(fact: DataFrame, areas: DataFrame, fact_key: str, area_key: str, name: str) -> DataFrame:
    """Add the area name; facts of unknown areas are left out."""
    return join_dimension(fact, areas, fact_key, area_key, [name])


def enrich_writeback(spark: SparkSession, base: str, table: str, namespace: str, areas: DataFrame, fact_key: str,
                     area_key: str, name: str) -> DataFrame:
    """Replace a stored table by itself with area names, and read it back."""
    overwrite_table(enrich(read_table(spark, base, table, namespace), areas, fact_key, area_key, name), base, table, namespace)
    return read_table(spark, base, table, namespace)


def price_series(price: DataFrame, day: str, purchase: str, sales: str) -> DataFrame:
    return sort_by_time(price.select(day, F.col(purchase).alias("purchase"), F.col(sales).alias("sales")), day)
