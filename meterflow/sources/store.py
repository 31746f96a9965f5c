"""Series stored by chunk, so that operators over them shuffle no rows."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.layout import CHUNK, HOME, INDEX, Series, own_columns, with_halo, with_index
from .tables import files_of, listed, table_path

ROWS = "rows"


def _by(s: Series) -> list[str]:
    return [*s.keys, CHUNK]


def write_store(df: DataFrame, s: Series, base: str, name: str, namespace: str, before: int = 167, after: int = 0, buckets: int | None = None) -> None:
    """Store a regular series as buckets of (keys, chunk), in time order, each chunk with the ``before`` and ``after`` rows that frames
    reach over its ends. The rows are shuffled here once, and no more by W1, W2, W4, W5 and W8 over what ``read_store`` gives.

    A chunk is bounded, so buckets are even however long a series is. The table must not be there yet: to replace it, write another.
    """
    if not s.regular:
        raise ValueError("only a regular series is stored by chunk: the places of other rows move when some are added")
    spark, path = df.sparkSession, table_path(base, name, namespace)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_halo(with_index(df, s), s, before, after)
    files, kind = files_of(spark, path)
    if listed(files, kind(path)):
        raise FileExistsError(path)
    table = f"store_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, *_by(s)).write.bucketBy(buckets, *_by(s)).sortBy(*_by(s), INDEX)
    try:
        writer.option("path", f"{path}/{ROWS}").saveAsTable(table)
    finally:
        spark.sql(f"drop table if exists {table}")  # the files stay: the table is external
    # Written last, this says that the rows are complete, and how they lie.
    files.createNewFile(kind(f"{path}/store.{buckets}.{before}.{after}.{s.chunk}.{int(s.step.total_seconds() * 1_000_000)}"))


def read_store(spark: SparkSession, s: Series, base: str, name: str, namespace: str) -> tuple[DataFrame, Series]:
    """A table stored by ``write_store``, and the series to give to operators with it. Its helper columns are theirs; ``plain`` leaves them out."""
    path = table_path(base, name, namespace)
    files, kind = files_of(spark, path)
    marks = [n for n in listed(files, kind(path)) if n.startswith("store.")]
    if not marks:
        raise FileNotFoundError(f"{path}: no store, or one that was not finished")
    buckets, before, after, chunk, step = map(int, marks[0].split(".")[1:])
    if (chunk, step) != (s.chunk, int(s.step.total_seconds() * 1_000_000)):
        raise ValueError(f"{path}: stored in chunks of {chunk} steps of {step} microseconds")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{ROWS}").schema.fields)
    table, by = f"store_{uuid.uuid4().hex}", ", ".join(f"`{c}`" for c in _by(s))
    spark.sql(f"create table {table} ({fields}) using parquet clustered by ({by}) sorted by ({by}, `{INDEX}`) into {buckets} buckets location '{path}/{ROWS}'")
    try:
        stored = spark.table(table)
    finally:
        spark.sql(f"drop table {table}")
    return stored, s.over(halo=(before, after))


def plain(stored: DataFrame) -> DataFrame:
    """The rows of a stored table as they were given."""
    return stored.filter(F.col(HOME)).select(*own_columns(stored))
