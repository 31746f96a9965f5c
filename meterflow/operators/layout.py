"""How a table of series is cut into bounded pieces.

A window over a whole series would put that series into one task, and one series
may hold a third of the table. So every ordered operator here works in two levels:

* rows are grouped by (series keys, chunk), a chunk being a fixed stretch of the
  time axis, and windows run inside a chunk;
* what one chunk must know of the others is carried by a small table with one row
  per (keys, chunk), built by a map-side combined aggregate, run through a window
  over the keys, and joined back on (keys, chunk) - the partitioning the chunk
  windows already have, so the rows themselves are shuffled once;
* row frames that reach over a chunk's edge get the few neighbouring rows copied
  into the chunk first (``with_halo``).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.times import epoch_micros
from ..sources.storage import settled

CHUNK, INDEX, HOME, COUNT = "_chunk", "_index", "_home", "_count"
PIECE = "_piece"
CROWD = 64  # times as many rows as steps a chunk may hold
HOT, PIECES, OVER = 1024, 1024, 32  # see ``by_tie_chunk``


@dataclass(frozen=True)
class Series:
    """Which columns make a series, and how it is sampled.

    ``keys``     non-null columns naming one series; () for a single series
    ``time``     the time column, at most one row per (keys, time)
    ``step``     sampling interval, the unit in which chunks are measured; a longer one than the data's
                 puts more rows into a chunk, and more than ``CROWD`` times as many raise
    ``chunk``    chunk length in steps: the most rows one window group holds
    ``regular``  True if no step is left out, i.e. row frames are time frames; saves the numbering pass that
                 other tables need for row frames. Row frames raise if a step is missing or there twice
    ``halo``     of a table from ``sources.store.read_store``: rows are stored by chunk, with as many
                 neighbours before and after it, and no operator within that reach shuffles them
    ``parts``    tasks that the rows are dealt to by chunk. None: adaptive execution goes by the shuffle's bytes, which for rows
                 that compress well are far fewer than what a task holds
    """

    keys: tuple[str, ...]
    time: str
    step: timedelta = timedelta(hours=1)
    chunk: int = 4096
    regular: bool = False
    halo: tuple[int, int] | None = None
    parts: int | None = None

    def over(self, **changes) -> Series:
        return replace(self, **changes)

    def slot(self, time: Column | str | None = None) -> Column:
        """Number of the step a time falls into, counted from 1970."""
        return floor_div(epoch_micros(self.time if time is None else time), self.step // timedelta(microseconds=1))

    def chunk_of(self, index: Column) -> Column:
        return floor_div(index, self.chunk)

    def local(self, order: str | None = None) -> WindowSpec:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(order or self.time)

    def next_value(self, column: str, order: str | None = None) -> Column:
        """The first non-null value after a row, within its chunk.

        A ``first`` over the rows that follow would walk them again for every row;
        ``lead`` moves on once. The DataFrame function has no IGNORE NULLS.
        """
        by = ", ".join(f"`{k}`" for k in (*self.keys, CHUNK))
        return F.expr(f"lead(`{column}`, 1) ignore nulls over (partition by {by} order by `{order or self.time}`)")

    def earlier(self) -> WindowSpec:
        """Over the one-row-per-chunk table: the chunks before this one."""
        return Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)

    def later(self) -> WindowSpec:
        """The chunks after this one, farthest first, so the frame only grows: take the last."""
        return Window.partitionBy(*self.keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)


SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def floor_div(value: Column, by: int) -> Column:
    """Exact for whole numbers: what is divided is a multiple of the divisor, and the quotient far below 2**52."""
    return F.round((value - F.pmod(value, F.lit(by))) / F.lit(by)).cast("bigint")


HELPERS = (CHUNK, INDEX, HOME)


def own_columns(df: DataFrame) -> list[str]:
    """The columns of a table without those a stored one has beside them."""
    return [c for c in df.columns if c not in HELPERS]


def by_time_chunk(df: DataFrame, s: Series) -> DataFrame:
    return df.filter(HOME) if s.halo else df.withColumn(CHUNK, s.chunk_of(s.slot()))


def by_tie_chunk(df: DataFrame, s: Series, tie: Sequence[str]) -> DataFrame:
    """Chunks of a table that may have any share of its rows at one time: ``CHUNK`` and, inside it, ``PIECE``.

    A chunk with more than a ``HOT`` part of all rows is cut at some of its own (time, tie), so that a piece has about a
    ``PIECES`` part. There are fewer than ``HOT`` such chunks and ``PIECES`` + ``HOT`` cuts, whatever the table, which is
    what every task gets. Cuts are picked by a hash of what they are made of: whoever computes them finds the same ones,
    and nothing has to be stored.
    """
    chunked = by_time_chunk(df, s)
    by = [*s.keys, CHUNK]
    sizes = chunked.groupBy(*by).agg(F.count("*").alias(COUNT))
    total = sizes.agg(F.sum(COUNT)).scalar()
    hot = sizes.filter((F.col(COUNT) > s.chunk) & (F.col(COUNT) * HOT > total)).withColumn("_share", F.col(COUNT) / total)
    place = F.struct(s.time, *tie)
    hashed = F.pmod(F.xxhash64(s.time, *tie), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Among ``OVER`` * pieces places picked at random, every ``OVER``-th is a cut.
    wanted = OVER * PIECES * F.col("_share")
    picked = _null_safe(chunked, F.broadcast(hot), by).filter(hashed * F.col(COUNT) < wanted).select(*by, place.alias("_place")).distinct()
    at = F.sort_array(F.collect_list("_place"))
    cuts = picked.groupBy(*by).agg(F.filter(at, lambda x, i: i % OVER == OVER - 1).alias("_cuts"))
    cuts = cuts.withColumn("_heads", F.filter("_cuts", lambda x, i: i % OVER == 0))
    rows = _null_safe(chunked, F.broadcast(cuts), by, "left")
    # The number of cuts at or before a row: heads first, then the cuts behind the last head that is.
    heads = F.size(F.filter("_heads", lambda x: x <= place))
    rest = F.size(F.filter(F.slice("_cuts", (F.greatest(heads, F.lit(1)) - 1) * OVER + 1, F.lit(OVER)), lambda x: x <= place))
    piece = F.when(heads > 0, (heads - 1) * OVER + rest).otherwise(0)
    return rows.withColumn(PIECE, F.coalesce(F.when(F.col("_cuts").isNotNull(), piece), F.lit(0))).select(*df.columns, CHUNK, PIECE)


def _null_safe(rows: DataFrame, small: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null."""
    named = small.select(*[F.col(c).alias(f"_of_{c}") for c in by], *[c for c in small.columns if c not in by])
    on = reduce(and_, [rows[c].eqNullSafe(named[f"_of_{c}"]) for c in by])
    return rows.join(F.broadcast(named), on, how).drop(*[f"_of_{c}" for c in by])


def by_range(df: DataFrame, order: Sequence[str]) -> DataFrame:
    ranged = df.repartitionByRange(*order).withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
    return settled(ranged, "ranges")


def chunk_table(chunked: DataFrame, s: Series, *aggregates: Column) -> DataFrame:
    """One row per (keys, chunk): the aggregates and the number of rows, combined map-side.

    Raises for a chunk that is far from bounded, as when seconds are taken for hours.
    """
    table = chunked.groupBy(*s.keys, CHUNK).agg(F.count("*").alias(COUNT), *aggregates)
    message = F.concat(F.lit("a chunk holds "), F.col(COUNT), F.lit(f" rows for {s.chunk} steps of {s.step}: give the series its sampling interval"))
    return table.filter(F.when(F.col(COUNT) <= s.chunk * CROWD, True).otherwise(F.raise_error(message).cast("boolean")))


def ends(s: Series) -> list[Column]:
    """Aggregates that ``no_gaps`` needs of a chunk."""
    return [F.min(INDEX).alias("_low"), F.max(INDEX).alias("_high")] if s.regular else []


def no_gaps(table: DataFrame, s: Series) -> DataFrame:
    """The chunk table of a regular series; raises if a step is left out of a series or there twice."""
    if not s.regular:
        return table
    series = Window.partitionBy(*s.keys)
    steps = F.max("_high").over(series) - F.min("_low").over(series) + 1
    checked = table.withColumns({"_steps": steps, "_all": F.sum(COUNT).over(series)})
    message = F.concat(F.lit("a regular series has "), F.col("_all"), F.lit(" rows for "), F.col("_steps"), F.lit(" steps"))
    fine = F.when(F.col("_steps") == F.col("_all"), True).otherwise(F.raise_error(message).cast("boolean"))
    return checked.filter(fine).drop("_steps", "_all", "_low", "_high")


def spread(df: DataFrame, s: Series) -> DataFrame:
    """Shuffle by (keys, chunk), unless the rows are stored that way.

    Asked for, because rows already hashed by the keys alone would count as clustered,
    and the chunks of one long series would stay in one task.
    """
    if s.halo:
        return df
    return df.repartition(s.parts, *s.keys, CHUNK) if s.parts else df.repartition(*s.keys, CHUNK)


def join_state(df: DataFrame, state: DataFrame, s: Series) -> DataFrame:
    """Give every row its chunk's state. Unique on (keys, chunk), so no row is multiplied."""
    return df.join(state, [*s.keys, CHUNK], "left")


def positioned(df: DataFrame, s: Series, tie: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows with their chunk, 0-based place in the series and the series' row count; and the chunk table.

    ``tie`` orders rows at the same time.
    """
    series = Window.partitionBy(*s.keys)
    if s.regular and not tie:  # the place is the number of steps since the first
        chunked = by_time_chunk(df, s).withColumn(INDEX, s.slot())
        table = chunk_table(chunked, s, *ends(s)).withColumn("_first", F.min("_low").over(series))
        state = no_gaps(table, s).select(*s.keys, CHUNK, "_first", F.sum(COUNT).over(series).alias(COUNT))
        return join_state(chunked, state, s).withColumn(INDEX, F.col(INDEX) - F.col("_first")).drop("_first"), state
    chunked = by_tie_chunk(df, s, tie) if tie else by_time_chunk(df, s).withColumn(PIECE, F.lit(0))
    by = [*s.keys, CHUNK, PIECE]
    table = (chunked.groupBy(*by).agg(F.count("*").alias(COUNT)) if tie else chunk_table(chunked, s).withColumn(PIECE, F.lit(0)))
    earlier = series.orderBy(CHUNK, PIECE).rowsBetween(Window.unboundedPreceding, -1)
    state = table.select(*by, F.coalesce(F.sum(COUNT).over(earlier), F.lit(0)).alias("_offset"), F.sum(COUNT).over(series).alias(COUNT))
    local = Window.partitionBy(*by).orderBy(s.time, *tie)
    numbered = chunked.repartition(*by).withColumn("_row", F.row_number().over(local)).join(state, by, "left")
    rows = numbered.withColumn(INDEX, F.col("_offset") + F.col("_row") - 1).drop("_offset", "_row", PIECE)
    return rows, state.select(*s.keys, CHUNK, COUNT).distinct()


def with_position(df: DataFrame, s: Series, name: str = INDEX, tie: Sequence[str] = ()) -> DataFrame:
    """Add each row's 0-based place in its series."""
    rows, _ = positioned(df, s, tie)
    return rows.select(*df.columns, F.col(INDEX).alias(name))


def with_index(df: DataFrame, s: Series) -> DataFrame:
    """Add the index that row frames run over: the step number, or the counted position."""
    if s.halo:
        return df.filter(HOME)
    return df.withColumn(INDEX, s.slot()) if s.regular else with_position(df, s)


def with_halo(indexed: DataFrame, s: Series, before: int, after: int = 0) -> DataFrame:
    """Copy rows into the chunks whose frames reach them.

    A frame of ``before`` rows back and ``after`` rows on, ordered by the index, is
    then complete for every row marked as at home in its chunk.
    """
    if s.halo:
        raise ValueError("a stored table has its neighbours with it: see framed")
    first, last = s.chunk_of(F.col(INDEX) - after), s.chunk_of(F.col(INDEX) + before)
    copies = spread(indexed.withColumn(CHUNK, F.explode(F.sequence(first, last))), s)
    return copies.withColumn(HOME, F.col(CHUNK) == s.chunk_of(F.col(INDEX)))


def framed(df: DataFrame, s: Series, before: int, after: int = 0) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the neighbours that their frames reach, and for a regular series the checked chunk table (see ``at_home``)."""
    indexed = with_index(df, s)
    chunked = indexed if s.halo else indexed.withColumn(CHUNK, s.chunk_of(F.col(INDEX)))
    table = no_gaps(chunk_table(chunked, s, *ends(s)), s) if s.regular else None
    return reached(df, indexed, s, before, after), table


def reached(df: DataFrame, indexed: DataFrame, s: Series, before: int, after: int = 0) -> DataFrame:
    """The rows with the neighbours that their frames reach: copied, or there already."""
    if not s.halo:
        return with_halo(indexed, s, before, after)
    if before > s.halo[0] or after > s.halo[1]:
        raise ValueError(f"frames reach {before} rows back and {after} on; the table is stored with {s.halo}")
    return df


def at_home(rows: DataFrame, table: DataFrame | None, s: Series) -> DataFrame:
    """Without the copies, when the frames are done. The chunk table raises if a regular series has gaps; it
    is an aggregate over keys and times only, and comes to the rows where they are."""
    own = rows.filter(HOME)
    if table is None:
        return own
    return join_state(own, table.select(*s.keys, CHUNK, COUNT), s).filter(F.coalesce(F.col(COUNT) > 0, F.lit(True)))


def whole(s: Series) -> WindowSpec:
    """All rows of a chunk, in the order that the frames have, so that one sort serves both."""
    return s.local(INDEX).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def global_rank(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """1-based place of each row in a total order over the whole table.

    The rows are cut into balanced ranges of that order and written, so that a range
    keeps its number; rows are then counted per range and numbered within it.
    """
    ranged = by_range(df, order)
    sizes = ranged.groupBy(CHUNK).agg(F.count("*").alias(COUNT))
    # One row per range: as many as the shuffle has partitions.
    before = F.sum(COUNT).over(Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(CHUNK, F.coalesce(before, F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(CHUNK).orderBy(*order))
    ranked = ranged.withColumn("_row", within).join(sizes, CHUNK)
    return ranked.withColumn(name, F.col("_offset") + F.col("_row")).drop("_offset", "_row", CHUNK)
