"""Where written tables go."""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCOPE = "spark.meterflow.scope"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one the session names, else one in its warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_steps"
    scope = spark.conf.get(SCOPE, None)
    return f"{base.rstrip('/')}/{scope}" if scope else base


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def steps_removed(spark: SparkSession) -> Iterator[None]:
    """Tables that steps write inside are deleted when it ends, also by an error.

    For a job that writes its result inside: what was only planned there has lost its steps by then.
    """
    before = spark.conf.get(SCOPE, None)
    spark.conf.set(SCOPE, f"{before}/{uuid.uuid4().hex}" if before else f"scope-{uuid.uuid4().hex}")
    folder = shared_folder(spark)
    try:
        yield
    finally:
        spark.conf.unset(SCOPE) if before is None else spark.conf.set(SCOPE, before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, name: str, **options) -> DataFrame:
    """The same rows as a written table: computed once however often they are used, and
    still there when an executor is lost. For results far smaller than what they come from. ``options`` are the writer's."""
    folder = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
