"""Named tables and document collections: scans, appends, overwrites, typed writes."""
from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null, row_id
from ..functions.times import month_of, ts
from ..operators.filters import time_range
from ..operators.layout import Series

# Stored type per in-flight type; anything else is stored as text (fixed values).
STORED_TYPES = {"int": "int", "bigint": "int", "float": "double", "double": "double", "string": "string",
                "boolean": "boolean", "timestamp": "timestamp_ntz", "timestamp_ntz": "timestamp_ntz"}
MONTH = "month"
VERSIONS = "_versions"  # hidden from readers of the table's own folder
DOCUMENT_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def table_path(base: str, name: str, namespace: str) -> str:
    return f"{base.rstrip('/')}/{namespace}/{name}"


def files_of(spark: SparkSession, path: str):
    """The file system a path is in, and the class of its paths."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def listed(files, folder) -> list[str]:
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and version of every commit of a table, in order. A commit is an empty file whose name says all: it is there or not."""
    files, kind = files_of(spark, path)
    names = [n.split(".", 2) for n in listed(files, kind(f"{path}/{VERSIONS}")) if n.startswith("commit.")]
    return sorted((int(number), version) for _, number, version in names)


def data_path(spark: SparkSession, base: str, name: str, namespace: str) -> str:
    """Where the rows of a table are: the version committed last, or the table's own folder if it was never replaced."""
    path = table_path(base, name, namespace)
    commits = _commits(spark, path)
    return f"{path}/{VERSIONS}/{commits[-1][1]}" if commits else path


def read_table(spark: SparkSession, base: str, name: str, namespace: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", clean: bool = False, **options) -> DataFrame:
    """A stored table, lazily: filters on any column and column choices reach the files. Tables written here hold no NaN;
    with ``clean`` those of a foreign table read as missing, and filters on such columns run after the scan."""
    reader = spark.read.format(fmt).options(**options)
    table = (reader.schema(schema) if schema else reader).load(data_path(spark, base, name, namespace))
    return nan_to_null(table) if clean else table


def write_table(df: DataFrame, base: str, name: str, namespace: str, insert: bool = True, add_id: bool = True,
                id_keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Append to a table (or replace it with ``insert=False``, see ``overwrite_table``), giving each row an id. NaN is stored as missing."""
    if not insert:
        overwrite_table(df, base, name, namespace, add_id, id_keys, partition_by)
        return
    df = nan_to_null(df)
    if add_id:
        df = df.withColumn("id", row_id(*id_keys))
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(data_path(df.sparkSession, base, name, namespace))


def write_series(df: DataFrame, s: Series, base: str, name: str, namespace: str, insert: bool = True, add_id: bool = True,
                 id_keys: Sequence[str] = ()) -> None:
    """Store a measurement table by month, each file a stretch of few series in time order.

    The rows are cut by range over (month, keys, time): a series or month of any size is
    spread evenly, and filters on time and entity skip partitions and files.
    """
    order = [MONTH, *s.keys, s.time]
    rows = df.withColumn(MONTH, month_of(s.time)).repartitionByRange(*order).sortWithinPartitions(*order)
    write_table(rows, base, name, namespace, insert, add_id, id_keys, partition_by=[MONTH])


def read_series(spark: SparkSession, s: Series, base: str, name: str, namespace: str, start, end) -> DataFrame:
    """A stretch of a table stored by month, from start up to but not including end."""
    months = F.col(MONTH).between(month_of(ts(start)), month_of(ts(end)))
    return time_range(read_table(spark, base, name, namespace).filter(months), s.time, start, end).drop(MONTH)


def overwrite_table(df: DataFrame, base: str, name: str, namespace: str, add_id: bool = False,
                    id_keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Replace a table, also by a result that was computed from it.

    The result is written once, as a version beside the rows that are read until then, and becomes the table by one step: an empty file that
    names it. Nothing is renamed. Whatever stops the job, readers find the old table or the new one, whole; what a stopped job
    left is removed by the next. The version before is kept for readers that already had found it.
    """
    spark, path = df.sparkSession, table_path(base, name, namespace)
    files, kind = files_of(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    df = nan_to_null(df)
    writer = (df.withColumn("id", row_id(*id_keys)) if add_id else df).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{VERSIONS}/{version}")
    number = max((n for n, _ in _commits(spark, path)), default=0) + 1
    if not files.createNewFile(kind(f"{path}/{VERSIONS}/commit.{number:012d}.{version}")):
        raise OSError(f"{path}: version {version} could not be committed")
    _drop_old(spark, path)
    spark.catalog.refreshByPath(path)


def _drop_old(spark: SparkSession, path: str) -> None:
    """Remove versions before the last two and, from the second commit on, rows stored without a version.

    Versions without a commit that another job may still be writing stay until a commit later than theirs has been followed by another.
    """
    files, kind = files_of(spark, path)
    commits = _commits(spark, path)
    kept, old = commits[-2:], commits[:-2]
    for number, version in old:  # the rows first: a commit without rows is never the last one
        files.delete(kind(f"{path}/{VERSIONS}/{version}"), True)
        files.delete(kind(f"{path}/{VERSIONS}/commit.{number:012d}.{version}"), False)
    if len(kept) == 2:
        for other in listed(files, kind(path)):
            if other != VERSIONS:
                files.delete(kind(f"{path}/{other}"), True)
        committed = {v for _, v in kept}
        since = files.getFileStatus(kind(f"{path}/{VERSIONS}/commit.{kept[0][0]:012d}.{kept[0][1]}")).getModificationTime()
        for other in listed(files, kind(f"{path}/{VERSIONS}")):
            folder = kind(f"{path}/{VERSIONS}/{other}")
            if other.startswith("v-") and other not in committed and files.getFileStatus(folder).getModificationTime() < since:
                files.delete(folder, True)


def typed_columns(df: DataFrame, types: Mapping[str, str] = STORED_TYPES) -> DataFrame:
    """Every column as its stored type, unknown types as text; whole numbers that do not fit raise."""
    return df.select(*[F.col(f.name).cast(types.get(f.dataType.simpleString(), "string")).alias(f.name) for f in df.schema.fields])


def typed_write(df: DataFrame, base: str, name: str, namespace: str, types: Mapping[str, str] = STORED_TYPES,
                id_keys: Sequence[str] = ()) -> None:
    """Create a table with ``id`` first and every column in its stored type, unless it exists."""
    df = nan_to_null(df)
    rest = typed_columns(df.drop("id"), types)
    ident = F.col("id").cast("string") if "id" in df.columns else row_id(*id_keys)
    rows = df.withColumn("id", ident).select("id", *[F.col(f.name).cast(f.dataType) for f in rest.schema.fields])
    rows.write.mode("ignore").parquet(table_path(base, name, namespace))


def insert_documents(df: DataFrame, base: str, name: str, namespace: str) -> None:
    """Append rows to a document collection as JSON lines."""
    df.write.mode("append").options(ignoreNullFields="false", timestampNTZFormat=DOCUMENT_TIME).json(table_path(base, name, namespace))


def read_documents(spark: SparkSession, base: str, name: str, namespace: str, schema: T.StructType | str) -> DataFrame:
    """A whole document collection without its implicit ``_id``."""
    return spark.read.schema(schema).option("timestampNTZFormat", DOCUMENT_TIME).json(table_path(base, name, namespace)).drop("_id")
