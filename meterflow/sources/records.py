"""Landed API payloads: documents of the form ``{"records": [ ... ]}``."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F
from pyspark.sql import types as T


def _fields(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _columns(records: DataFrame, fields: T.StructType, any_case: bool) -> DataFrame:
    """The columns of ``_r``, a struct, or for names in any case a map of texts."""
    if not any_case:
        return records.select("_r.*")
    named = records.select(F.transform_keys("_r", lambda k, v: F.lower(k)).alias("_r"))
    return named.select(*[F.col("_r")[f.name.lower()].cast(f.dataType).alias(f.name) for f in fields.fields])


def records_of(payloads: DataFrame, column: str, schema: T.StructType | str, any_case: bool = False) -> DataFrame:
    """One row per entry of each payload's ``records`` array. A payload that is no JSON raises.

    ``any_case`` finds the fields whatever the case of their names in the payload.
    """
    fields = _fields(schema)
    entry = "map<string, string>" if any_case else fields.simpleString()
    parsed = F.from_json(F.col(column), f"struct<records: array<{entry}>>", {"mode": "FAILFAST"})
    return _columns(payloads.select(F.explode(parsed["records"]).alias("_r")), fields, any_case)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, per_line: bool = False, any_case: bool = False) -> DataFrame:
    """Read payload files, one document per file (or per line).

    A document that is a file is read as pieces in as many tasks as its size asks for (see ``record_texts``).
    """
    if per_line:
        return records_of(spark.read.text(path), "value", schema, any_case)
    fields = _fields(schema)
    entry = T.MapType(T.StringType(), T.StringType()) if any_case else fields
    parsed = F.from_json("text", entry, {"mode": "FAILFAST"})
    return _columns(record_texts(spark, path).select(parsed.alias("_r")), fields, any_case)


_BLOCK = ["_file", "_block"]
STRETCH = 8192  # pieces of a block
PARTS = 4  # partitions of the pieces that one split read
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_TO_BRACE = rf'(?:[^"{{]++|{_STRING})*+\{{'


def _so_far() -> WindowSpec:
    return Window.partitionBy(*_BLOCK).orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _blocks_before() -> WindowSpec:
    return Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text``, the JSON of every object in the ``records`` array of the documents in ``path``, one document to a file.

    Files are read as pieces that end at a ``}``, so Spark splits a large one anywhere and no task holds a document. Whether a
    brace is inside a string, and how deep, follows from the pieces before it: quotes and braces are counted
    per block (at most ``STRETCH`` pieces of what one split of a file read), the counts of earlier blocks come through a table of one row per
    block, and running counts inside a block do the rest. An object that ends in the piece it began in, which is any
    flat one, is that piece; the pieces of others are put together by where the object began. A document that is no JSON, or cut off, raises.
    """
    read = spark.read.option("lineSep", "}").text(path)
    pieces = read.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start_of_split"),
                         F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_seq"), "value")
    stretch = F.floor((F.col("_seq").bitwiseAND((1 << 33) - 1)) / STRETCH)
    pieces = pieces.withColumn("_block", F.struct("_start_of_split", stretch.alias("_stretch"))).drop("_start_of_split")
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters, which are in strings only
    pieces = pieces.withColumn("_quotes", F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))))
    # By name, or blocks of one file would count as clustered by the file alone.
    # As many partitions as the splits ask for: pieces take far more memory than the bytes that adaptive execution goes by.
    rows = pieces.repartition(PARTS * max(1, read.rdd.getNumPartitions()), *_BLOCK)

    # Strings: an odd number of quotes so far.
    quotes = _before(pieces, F.sum("_quotes"))
    rows = rows.withColumn("_upto", F.sum("_quotes").over(_so_far())).join(quotes, _BLOCK)
    rows = rows.withColumns({"_inside": F.pmod(F.col("_before") + F.col("_upto") - F.col("_quotes"), F.lit(2)) == 1,
                             "_cut": F.pmod(F.col("_before") + F.col("_upto"), F.lit(2)) == 1}).drop("_before", "_upto")
    started = F.when(F.col("_inside"), F.regexp_replace(bare, '^[^"]*+("|$)', "")).otherwise(bare)
    shape = F.regexp_replace(started, '("records")|"[^"]*+(?:"|$)', "$1")  # strings are gone but for that name
    opened = F.length("_shape") - F.length(F.replace("_shape", F.lit("{"), F.lit("")))
    rows = rows.withColumn("_shape", shape).withColumn("_opened", opened).withColumn("_net", F.col("_opened") - (~F.col("_cut")).cast("int"))

    # Depth before and after a piece: the brace that ends it closes, unless it is in a string.
    rows = rows.withColumn("_upto", F.sum("_net").over(_so_far())).join(_before(rows, F.sum("_net")), _BLOCK)
    rows = rows.withColumns({"_end": F.col("_before") + F.col("_upto"), "_begin": F.col("_before") + F.col("_upto") - F.col("_net")}).drop("_before", "_upto")

    # Which array the objects of the document are in: what was opened or closed last outside of them.
    outer = F.when(F.col("_begin") == 1, F.regexp_extract("_shape", r"^[^{]*+", 0)).when(F.col("_begin") == 0, F.regexp_extract("_shape", r"^[^{]*+\{([^{]*+)", 1))
    last = F.regexp_replace(outer, r"(?s)^.*\]", "")
    marker = F.when(last.rlike(r'"records"\s*+:\s*+\['), True).when(outer.contains("]"), False)
    begins = ((F.col("_begin") == 1) & (F.col("_opened") > 0)) | ((F.col("_begin") == 0) & (F.col("_opened") > 1))
    at = F.struct("_block", "_seq")
    rows = rows.withColumns({"_marker": F.when(marker.isNotNull(), F.struct(at.alias("at"), marker.alias("open"))), "_start": F.when(begins, at)})
    rows = rows.withColumns({"_last_marker": F.max("_marker").over(_so_far()), "_last_start": F.max("_start").over(_so_far())})
    table = rows.groupBy(*_BLOCK).agg(F.max("_marker").alias("_m"), F.max("_start").alias("_s"), F.sum("_net").alias("_net"), F.sum("_quotes").alias("_quotes"),
                                      F.sum(F.octet_length("value") + 1).alias("_bytes"), F.max("_size").alias("_size"))
    table = table.withColumn("_ended", _ended()).filter("_ended").select(*_BLOCK, F.max("_m").over(_blocks_before()).alias("_m"), F.max("_s").over(_blocks_before()).alias("_s"))
    rows = rows.join(table, _BLOCK).withColumns({"_last_marker": F.coalesce("_last_marker", "_m"), "_last_start": F.coalesce("_last_start", "_s")}).drop("_m", "_s")

    # The text of an object begins behind what its document has before it.
    skip = F.when(F.col("_inside"), F.lit(r'^(?:[^"\\]++|\\.)*+"')).otherwise(F.lit("^"))
    skip = F.concat(skip, F.when(F.col("_begin") == 0, F.lit(_TO_BRACE)).otherwise(F.lit("")), F.lit(_TO_BRACE))
    ahead = F.length(F.regexp_substr("value", F.concat(F.lit("(?s)"), skip)))
    begun = F.col("_start").isNotNull()
    text = F.when(begun, F.expr("substring(value, _ahead)")).otherwise(F.col("value"))
    whole = begun & (F.col("_end") == 1) & ~F.col("_cut")
    within = F.col("_last_marker")["open"] & (begun | (F.col("_begin") > 1))
    parts = rows.withColumn("_ahead", ahead).withColumns({"text": text, "_whole": whole}).filter(_in_document()).filter(within)
    simple = parts.filter("_whole").select(F.concat("text", F.lit("}")).alias("text"))
    gathered = parts.filter("not _whole").groupBy("_file", "_last_start").agg(F.array_sort(F.collect_list(F.struct("_block", "_seq", "text"))).alias("_parts"))
    joined = F.concat(F.array_join(F.transform("_parts", lambda p: p["text"]), "}"), F.lit("}"))
    return simple.unionAll(gathered.select(joined.alias("text")))


def _before(rows: DataFrame, total: Column) -> DataFrame:
    """Per block the total over the blocks before it in its file."""
    table = rows.groupBy(*_BLOCK).agg(total.alias("_total"))
    return table.select(*_BLOCK, F.coalesce(F.sum("_total").over(_blocks_before()), F.lit(0)).alias("_before"))


def _failing(fine: Column, message: str) -> Column:
    return F.when(fine, True).otherwise(F.raise_error(F.concat(F.lit(message), F.col("_file"))).cast("boolean"))


def _in_document() -> Column:
    """True, or an error at text outside of the document, or a brace that closes nothing."""
    outside = F.when(F.col("_begin") == 0, F.regexp_extract("_shape", r"^[^{]*+", 0)).otherwise(F.lit(""))
    return _failing((F.col("_begin") >= 0) & outside.rlike(r"^\s*+$"), "MALFORMED_RECORD, no JSON document: ")


def _ended() -> Column:
    """True for blocks of a file whose strings and braces are all closed. What comes behind the last brace counts as a piece that closes
    one; there is such a piece if the pieces and a brace for each have more bytes than the file."""
    of_file = Window.partitionBy("_file")
    total = lambda c: F.sum(c).over(of_file)
    behind = (total("_bytes") > F.col("_size")).cast("int")
    return _failing((total("_net") + behind == 0) & (total("_quotes") % 2 == 0), "MALFORMED_RECORD, a JSON document that does not end: ")
