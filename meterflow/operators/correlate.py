"""Pairing and correlating series."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .layout import CHUNK, INDEX, SO_FAR, Series, at_home, floor_div, framed, own_columns


def align_series(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of two series side by side on the union of their times."""
    return left.join(right, list(on), "full")


def pair_endog_exog(endog: DataFrame, exog: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A measure and its regressors at the times both have."""
    return endog.join(exog.select(*on, *columns), list(on))


def clip_to_range(df: DataFrame, time: str, other: DataFrame, other_time: str) -> DataFrame:
    """Keep the rows within another series' first and last time, both included."""
    low = other.agg(F.min(other_time)).scalar()
    high = other.agg(F.max(other_time)).scalar()
    return df.filter((F.col(time) >= low) & (F.col(time) <= high))


def sliding_corr(df: DataFrame, s: Series, x: str, y: str, width: int, name: str = "corr") -> DataFrame:
    """Correlation over a centred frame of ``width`` rows.

    Null unless the whole frame holds pairs, and where either side is constant. The rows are cut into blocks of ``width``: a
    frame is the end of one block and the start of the next, or one block. Moments are carried along every block
    once forward and once back, so a frame is one merge of two rows' moments whatever its width, and no sum
    is taken apart again: small spreads on large values keep their digits.
    """
    if width < 1:
        return df.withColumn(name, F.lit(None).cast("double"))
    before, after = width // 2, (width - 1) // 2
    rows, table = framed(df, s, before, after)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    rows = rows.withColumns({"_px": F.when(both, F.col(x)), "_py": F.when(both, F.col(y)), "_block": floor_div(F.col(INDEX), width)})
    rows = rows.withColumn("_kcolb", -F.col("_block"))
    # Two sorts in all: up the chunk, for what is carried forth, and down it, for what is carried back and for the merge.
    block = Window.partitionBy(*s.keys, CHUNK, "_block")
    forth = block.orderBy(INDEX).rowsBetween(*SO_FAR)
    back = Window.partitionBy(*s.keys, CHUNK, "_kcolb").orderBy(F.desc(INDEX)).rowsBetween(*SO_FAR)
    # Each block is measured from a value of its own, so that means keep the digits of the differences.
    anywhere = block.orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({f"_o{p}": F.first(f"_p{p}", ignorenulls=True).over(anywhere) for p in "xy"})
    rows = rows.withColumns({f"_q{p}": F.col(f"_p{p}") - F.col(f"_o{p}") for p in "xy"})
    rows = rows.withColumn("_start", _moments(forth)).withColumn("_end", _moments(back))
    down = Window.partitionBy(*s.keys, CHUNK).orderBy("_kcolb", F.desc(INDEX))
    rows = rows.withColumns({"_end": F.lead("_end", before).over(down), "_start": F.lag("_start", after).over(down)})
    one_block = F.pmod(F.col(INDEX) - before, F.lit(width)) == 0
    alone = F.struct(*[F.col(f"_start.{k}") for k in ("n", *_SPREADS, *_PRODUCTS)])
    rows = rows.withColumn("_frame", F.when(one_block, alone).otherwise(_merged("_end", "_start")))
    m = lambda field: F.col(f"_frame.{field}")
    usable = (m("n") == width) & (m("lx") < m("hx")) & (m("ly") < m("hy")) & (m("xx") > 0) & (m("yy") > 0)
    value = F.when(usable, m("xy") / (F.sqrt(m("xx")) * F.sqrt(m("yy"))))
    return at_home(rows, table, s).withColumn(name, value).select(*dict.fromkeys([*own_columns(df), name]))


_SPREADS, _PRODUCTS = ("lx", "hx", "ly", "hy"), ("xx", "yy", "xy")


def _moments(over: WindowSpec) -> Column:
    """Count, least and greatest values, origins, means from there and sums of squares and products about the means."""
    n = F.count("_px").over(over)
    scaled = lambda f: F.coalesce(f.over(over), F.lit(0.0))
    origin = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    ends = [f(f"_p{c}").over(over).alias(k + c) for c in "xy" for k, f in (("l", F.min), ("h", F.max))]
    return F.struct(n.alias("n"), *ends, origin("_ox").alias("ox"), origin("_oy").alias("oy"), scaled(F.avg("_qx")).alias("x"), scaled(F.avg("_qy")).alias("y"),
                    (scaled(F.var_pop("_qx")) * n).alias("xx"), (scaled(F.var_pop("_qy")) * n).alias("yy"), (scaled(F.covar_pop("_qx", "_qy")) * n).alias("xy"))


def _merged(a: str, b: str) -> Column:
    """Moments of two stretches together; null if either is not there."""
    f = lambda side, field: F.col(f"{side}.{field}")
    n = f(a, "n") + f(b, "n")
    share = F.coalesce(f(a, "n") * f(b, "n") / F.nullif(n, F.lit(0)), F.lit(0.0))
    ends = [pick(f(a, k + c), f(b, k + c)).alias(k + c) for c in "xy" for k, pick in (("l", F.least), ("h", F.greatest))]
    dx, dy = ((f(b, "o" + c) - f(a, "o" + c)) + (f(b, c) - f(a, c)) for c in "xy")
    about = {"xx": dx * dx, "yy": dy * dy, "xy": dx * dy}
    return F.struct(n.alias("n"), *ends, *[(f(a, k) + f(b, k) + d * share).alias(k) for k, d in about.items()])
