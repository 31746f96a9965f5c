"""Cosine-transform low-pass smoothing (type II, the first coefficients kept)."""
from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import DataFrame, functions as F

from .fill import _names
from .joins import with_scalars
from .layout import CHUNK, COUNT, INDEX, Series, join_state, positioned


def _cosines(rows: DataFrame, upto: int) -> DataFrame:
    """Columns ``_c1`` to ``_c<upto>``, cos(k * angle), from one cosine a row.

    cos((m + j) a) = 2 cos(m a) cos(j a) - cos((m - j) a) gives as many again from those there are, so the
    columns take log2(upto) projections and the rounding grows no faster than that.
    """
    c = lambda k: F.col(f"_c{k}") if k else F.lit(1.0)
    if upto:
        rows = rows.withColumn("_c1", F.cos((F.col(INDEX) * 2 + 1) * math.pi / (F.col(COUNT) * 2)))
    m = 1
    while m < upto:
        rows = rows.withColumns({f"_c{m + j}": c(m) * c(j) * 2 - c(m - j) for j in range(1, min(m, upto - m) + 1)})
        m = min(2 * m, upto)
    return rows


def dct_smooth(df: DataFrame, s: Series, columns: str | Sequence[str], max_val: int = 10,
               suffix: str = "_smooth", tie: Sequence[str] = ()) -> DataFrame:
    """Keep cosine coefficients 0..max_val of each series and transform back.

    The coefficients are plain sums, so every series is reduced map-side to
    ``max_val + 1`` numbers; they come back to the rows by (keys, chunk). A series
    with a missing value smooths to null throughout; rows without a key are in no series.
    """
    cols = _names(columns)
    # Said here, as the joins infer it for one of the two uses of the rows only: with equal
    # plans the shuffled rows are read twice instead of being shuffled twice.
    known = df.filter(reduce(and_, [F.col(k).isNotNull() for k in s.keys])) if s.keys else df
    rows, chunks = positioned(known, s, tie)
    turned = _cosines(rows, max_val)
    cosine = lambda k: F.col(f"_c{k}") if k else F.lit(1.0)
    coefficients = []
    for c in cols:
        # Only as many coefficients exist as the series has rows.
        sums = [F.when(F.max(COUNT) > k, F.sum(F.col(c) * cosine(k)) * (2.0 if k else 1.0) / F.max(COUNT)).otherwise(0.0)
                for k in range(max_val + 1)]
        complete = F.count(c) == F.max(COUNT)
        coefficients.append(F.when(complete, F.array(*sums)).alias(f"_x_{c}"))
    found = turned.groupBy(*s.keys).agg(*coefficients)
    chunks = chunks.select(*s.keys, CHUNK)
    state = chunks.join(found, list(s.keys), "left") if s.keys else with_scalars(chunks, found)
    out = _cosines(join_state(rows, state, s), max_val)
    smooth = {c + suffix: reduce(add, [F.get(f"_x_{c}", F.lit(k)) * cosine(k) for k in range(max_val + 1)]) for c in cols}
    return out.withColumns(smooth).select(*df.columns, *smooth)
