"""Filling missing values."""
from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import truncate_whole
from .layout import (CHUNK, COUNT, CROWD, HOME, INDEX, SO_FAR, Series, at_home, by_time_chunk, chunk_table, ends, framed, join_state,
                     no_gaps, own_columns, reached, spread, whole, with_index)


def last_known(column: str, order: str) -> Column:
    """Latest non-null value of a group; merges map-side, unlike an ordered ``last``."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def next_known(column: str, order: str) -> Column:
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def forward_fill(df: DataFrame, s: Series, columns: str | Sequence[str]) -> DataFrame:
    """Replace missing values by the last known one; leading gaps stay."""
    cols = _names(columns)
    chunked = by_time_chunk(df, s)
    state = chunk_table(chunked, s, *[last_known(c, s.time).alias(f"_{c}") for c in cols]).select(
        *s.keys, CHUNK, *[F.last(f"_{c}", ignorenulls=True).over(s.earlier()).alias(f"_before_{c}") for c in cols])
    here = s.local().rowsBetween(*SO_FAR)
    filled = spread(chunked, s).withColumns({c: F.last(c, ignorenulls=True).over(here) for c in cols})
    out = join_state(filled, state, s)
    return out.withColumns({c: F.coalesce(c, f"_before_{c}") for c in cols}).select(*own_columns(df))


def backward_fill(df: DataFrame, s: Series, columns: str | Sequence[str]) -> DataFrame:
    """Replace missing values by the next known one; trailing gaps stay."""
    cols = _names(columns)
    chunked = by_time_chunk(df, s)
    state = chunk_table(chunked, s, *[next_known(c, s.time).alias(f"_{c}") for c in cols]).select(
        *s.keys, CHUNK, *[F.last(f"_{c}", ignorenulls=True).over(s.later()).alias(f"_after_{c}") for c in cols])
    filled = spread(chunked, s).withColumns({c: F.coalesce(F.col(c), s.next_value(c)) for c in cols})
    out = join_state(filled, state, s)
    return out.withColumns({c: F.coalesce(c, f"_after_{c}") for c in cols}).select(*own_columns(df))


def trailing_means(rows: DataFrame, s: Series, wanted: dict[str, tuple[str, int]], beside: dict[str, Column] | None = None) -> DataFrame:
    """Means of frames that end in each row, by name: (column, rows of the frame).

    ``rows`` carry the neighbours of their chunk. A mean is the difference of two running sums, so a row costs the
    same whatever the frame. Nothing cancels: a value is split at units that are powers of two, chosen by the
    largest value of the chunk so that the running sums of the first two parts are exact; what is left has less than a
    2 ** -50th of that value. Values that are not finite count as missing. ``beside`` are window columns in the order of the
    index, which share a pass over the rows.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    most = (s.chunk * (1 if s.regular else CROWD) + max(w for _, w in wanted.values())).bit_length()
    rows = rows.withColumns({f"_v_{c}": F.when(F.abs(c) < float("inf"), F.col(c).cast("double")) for c in columns})
    largest = {c: F.nullif(F.max(F.abs(f"_v_{c}")).over(whole(s)), F.lit(0.0)) for c in columns}
    units = {f"_u_{c}": F.pow(F.lit(2.0), F.ceil(F.log2(largest[c])) + (most - 51)) for c in columns}
    rows = rows.withColumns({**units, **(beside or {})})

    def part(value: Column, unit: Column) -> Column:
        return F.when(unit > 0, F.rint(value / unit) * unit).otherwise(value * 0)

    rows = rows.withColumns({f"_a_{c}": part(F.col(f"_v_{c}"), F.col(f"_u_{c}")) for c in columns})
    rows = rows.withColumns({f"_b_{c}": part(F.col(f"_v_{c}") - F.col(f"_a_{c}"), F.col(f"_u_{c}") * 2.0 ** (most - 52)) for c in columns})
    so_far = s.local(INDEX).rowsBetween(*SO_FAR)
    parts = {c: {"a": F.sum(f"_a_{c}"), "b": F.sum(f"_b_{c}"), "c": F.sum(F.col(f"_v_{c}") - F.col(f"_a_{c}") - F.col(f"_b_{c}")),
                 "n": F.count(f"_v_{c}")} for c in columns}
    rows = rows.withColumns({f"_sums_{c}": F.struct(*[f.over(so_far).alias(k) for k, f in fs.items()]) for c, fs in parts.items()})
    windows = sorted({w for _, w in wanted.values()})
    rows = rows.withColumns({f"_before_{w}": F.lag(F.struct(*[f"_sums_{c}" for c in columns if (c, w) in wanted.values()]), w).over(s.local(INDEX))
                             for w in windows})

    def mean(c: str, w: int) -> Column:
        grown = {k: F.col(f"_sums_{c}.{k}") - F.coalesce(F.col(f"_before_{w}._sums_{c}.{k}"), F.lit(0)) for k in parts[c]}
        return (grown["a"] + (grown["b"] + grown["c"])) / F.nullif(grown["n"], F.lit(0))

    helpers = [f"_{k}_{c}" for c in columns for k in ("v", "u", "a", "b", "sums")] + [f"_before_{w}" for w in windows]
    return rows.withColumns({name: mean(c, w) for name, (c, w) in wanted.items()}).drop(*helpers)


@dataclass(frozen=True)
class Rule:
    """How one column is filled.

    ``method``           "rolling" (trailing mean, then next known value), "forward",
                         "backward", "zero" or "keep"
    ``window``           rows of the trailing mean, the current one included
    ``max_missing_pct``  fill only series missing strictly less than this (0..100)
    ``entities``         fill only these values of the first series key
    ``whole``            cut the filled column to whole numbers (code columns)
    """

    column: str
    method: str = "rolling"
    window: int = 24
    max_missing_pct: float | None = None
    entities: tuple | None = None
    whole: bool = False


def impute(df: DataFrame, s: Series, rules: Iterable[Rule]) -> DataFrame:
    """Apply every rule in one pass: one shuffle of the rows, whatever the number of columns.

    The trailing mean sees original values only. Where its frame is empty, the next
    frame that is not empty ends in the next known value and holds nothing else, so
    "back-fill the rolling mean" is "take the next known value".
    """
    rules = [r for r in rules if r.method != "keep" or r.whole]
    rolling = [r for r in rules if r.method == "rolling"]
    forward = [r for r in rules if r.method == "forward"]
    backward = [r for r in rules if r.method in ("rolling", "backward")]
    gated = [r for r in rules if r.max_missing_pct is not None]

    if rolling:
        indexed = with_index(df, s)
        source = indexed.withColumn(CHUNK, s.chunk_of(F.col(INDEX))) if not s.halo else indexed
        rows, order = reached(df, indexed, s, max(r.window for r in rolling) - 1), INDEX
    else:
        source = by_time_chunk(df, s)
        rows, order = spread(source, s) if forward or backward else source, s.time

    state = _chunk_state(source, s, order, forward, backward, gated)
    local = s.local(order)
    values = {}
    for r in backward:
        values[f"_next_{r.column}"] = s.next_value(r.column, order)
    for r in forward:
        values[f"_last_{r.column}"] = F.last(r.column, ignorenulls=True).over(local.rowsBetween(*SO_FAR))
    if rolling:
        rows = trailing_means(rows, s, {f"_mean_{r.column}": (r.column, r.window) for r in rolling}, values).filter(HOME)
    elif values:
        rows = rows.withColumns(values)
    if state is not None:
        rows = join_state(rows, state, s)
    return rows.withColumns({r.column: _filled(r, s) for r in rules}).select(*own_columns(df))


def _chunk_state(source, s, order, forward, backward, gated) -> DataFrame | None:
    aggregates = [last_known(r.column, order).alias(f"_l_{r.column}") for r in forward]
    aggregates += [next_known(r.column, order).alias(f"_n_{r.column}") for r in backward]
    aggregates += [F.count(r.column).alias(f"_c_{r.column}") for r in gated]
    if not aggregates:
        return None
    summary = chunk_table(source, s, *aggregates, *(ends(s) if order == INDEX else []))
    if order == INDEX:
        summary = no_gaps(summary, s)
    series = Window.partitionBy(*s.keys)
    carried = [F.last(f"_l_{r.column}", ignorenulls=True).over(s.earlier()).alias(f"_before_{r.column}")
               for r in forward]
    carried += [F.last(f"_n_{r.column}", ignorenulls=True).over(s.later()).alias(f"_after_{r.column}")
                for r in backward]
    total = F.sum(COUNT).over(series)
    carried += [((total - F.sum(f"_c_{r.column}").over(series)) * 100 / total).alias(f"_pct_{r.column}") for r in gated]
    return summary.select(*s.keys, CHUNK, *carried)


def _filled(r: Rule, s: Series) -> Column:
    x = F.col(r.column)
    if r.method == "rolling":
        value = F.coalesce(x, F.col(f"_mean_{r.column}"), F.col(f"_next_{r.column}"), F.col(f"_after_{r.column}"))
    elif r.method == "backward":
        value = F.coalesce(x, F.col(f"_next_{r.column}"), F.col(f"_after_{r.column}"))
    elif r.method == "forward":
        value = F.coalesce(x, F.col(f"_last_{r.column}"), F.col(f"_before_{r.column}"))
    elif r.method == "zero":
        value = F.coalesce(x, F.lit(0.0))
    elif r.method == "keep":
        value = x
    else:
        raise ValueError(f"unknown fill method {r.method!r}")
    allowed = F.lit(True)
    if r.max_missing_pct is not None:
        allowed = allowed & (F.col(f"_pct_{r.column}") < r.max_missing_pct)
    if r.entities is not None:
        allowed = allowed & F.col(s.keys[0]).isin(*r.entities)
    value = F.when(allowed, value).otherwise(x)
    return truncate_whole(value) if r.whole else value


def impute_rolling(df: DataFrame, s: Series, column: str, window: int = 24, entities: tuple | None = None) -> DataFrame:
    return impute(df, s, [Rule(column, window=window, entities=entities)])


def impute_threshold(df: DataFrame, s: Series, column: str, window: int = 24, max_missing_pct: float = 40.0) -> DataFrame:
    return impute(df, s, [Rule(column, window=window, max_missing_pct=max_missing_pct)])


def rolling_mean(df: DataFrame, s: Series, column: str, window: int = 24, name: str = "rolling") -> DataFrame:
    """Trailing mean over ``window`` rows, missing values skipped; null where the frame has none."""
    rows, table = framed(df, s, window - 1)
    means = trailing_means(rows, s, {"_mean": (column, window)})
    return at_home(means, table, s).withColumn(name, F.col("_mean")).select(*dict.fromkeys([*own_columns(df), name]))


def fill_constant(df: DataFrame, columns: Sequence[str], value=0) -> DataFrame:
    return df.fillna({c: value for c in columns})


def fill_all(df: DataFrame, value=0) -> DataFrame:
    """Fill every numeric column; text columns are left alone."""
    return df.fillna(value)
