"""Steps of a job as written tables."""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..sources.storage import settled

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that go to a Python worker at a time; a longer row goes alone.
BATCH_BYTES = 4 << 20


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _shuffles_removed(spark: SparkSession):
    """Shuffle files of what runs inside go when each action ends, not when the driver happens to collect garbage."""
    return _set(spark, _CLEANUP, "true")


def small_batches(spark: SparkSession):
    """Actions inside pass rows to workers some ``BATCH_BYTES`` at a time: neither side holds ten thousand texts, nor the JVM their copies in growing buffers."""
    return _set(spark, _BATCH, str(BATCH_BYTES))


def step(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows as a table in the folder that all executors share: the end of a lineage. The shuffles behind it are removed."""
    with _shuffles_removed(df.sparkSession):
        return settled(df, name, **options)
