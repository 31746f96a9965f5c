"""Contiguous shards of equal size: prefix sums of bytes over ranges of ids, cut at equal targets."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.storage import settled

ROWS_PER_RANGE = 2_000_000


def with_offsets(rows: DataFrame, order: list[str], size: str, ranges: int | None = None) -> DataFrame:
    """Add ``start`` (sum of ``size`` before the row), ``number`` (rows before it) and ``total`` (sum of all), in the given order over the whole table.

    Rows are dealt by range of (order, row id) and stored, so that ranges hold equal numbers of rows however
    often a value repeats, and stay as they are when a task is run again. The totals of the ranges are one row
    each; running sums inside a range start from the sum of the totals before it.
    """
    spark = rows.sparkSession
    parts = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_RANGE)
    dealt = (rows.withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(parts, *order, "_row").withColumn("_range", F.spark_partition_id()))
    held = settled(dealt, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy("_range").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    firsts = totals.select("_range", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
                           F.sum("_bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("_range").orderBy(*order, "_row")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = held.withColumns({"_start": F.coalesce(F.sum(size).over(earlier), F.lit(0)), "_number": F.row_number().over(inside) - 1})
    return (numbered.join(firsts, "_range")
            .withColumns({"start": F.col("_start") + F.col("_bytes"), "number": F.col("_number") + F.col("_rows")})
            .drop("_range", "_row", "_start", "_number", "_bytes", "_rows"))


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Deal documents, in the order of their ids, into ``shards`` contiguous shards of near equal bytes.

    Returns one row per input row (repeated rows stay, in any order among themselves): the id, ``size`` (UTF-8
    bytes of the text, none for a null, plus 1), ``text_crc32`` (unsigned, 0 for an empty or null text), ``shard``,
    ``slot`` (place in the shard, gapless from 0) and the ``carry`` columns. A row belongs to the shard in which the middle of its bytes
    falls: a shard is off its target by less than the two rows at its ends. Null ids come first. With fewer rows
    than shards, or one row larger than a target, some shards are empty. Only ids and sizes are shuffled
    unless ``carry`` asks for more.
    """
    text_bytes = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_column), (F.octet_length(text_bytes) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text_bytes).alias("text_crc32"), *carry)
    placed = with_offsets(rows, [id_column, "text_crc32", "size"], "size")
    placed = placed.withColumn("shard", F.expr(f"cast(least({shards - 1}, ((2 * start + size) * {shards}) div (2 * total)) as int)"))
    firsts = placed.groupBy("shard").agg(F.min("number").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        id_column, "size", "text_crc32", "shard", (F.col("number") - F.col("_first")).alias("slot"), *carry)


def write_shards(docs: DataFrame, folder: str, shards: int = 8, id_column: str = "doc_id", text: str = "text") -> None:
    """Write the documents, all their columns as they are, as folders ``shard=0`` to ``shard=n``, rows of each file in the order of their
    slots. If a column is named ``shard``, the folders are named ``shard_=0`` and so on. An empty table writes no shard."""
    name = "shard"
    while name in docs.columns:
        name += "_"
    # Carried as one value, the columns meet none of those that the cuts need.
    whole = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("body"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    dealt = shard_by_bytes(whole, shards, "id", "body", ("row",))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("row.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(folder)


def op9_byte_shards(spark, sf_dir: str) -> DataFrame:
    """The documents in eight shards of near equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_by_bytes(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
