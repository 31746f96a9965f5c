"""Connected components of a link table."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import step


AT_ONCE = 2_000_000


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node ``a`` to the smaller ``b``."""
    return links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours of each node (large: those above it; small: those below it) and the node itself to the least node among
    the node and all of them. Nodes stay connected as they were."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    own = both.where(F.col("b") > F.col("a")) if large else both
    moved = own.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionAll(least.select("a", F.col("m").alias("b"))))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that tie the same nodes together, each node to the least one of its component."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[:len(a)], place[len(a):]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    tied = root != np.arange(len(ids))
    return ids[tied], ids[root[tied]]


def _within_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of each ``AT_ONCE`` links a task reads."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= AT_ONCE:
            yield _forest_of(held)
            held = []
    if held:
        yield _forest_of(held)


def _forest_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b = forest(*(np.concatenate([x.column(c).to_numpy() for x in batches]) for c in ("a", "b")))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``component``) of every node of the undirected links (``a``, ``b``): the least node that can be reached.

    Links that a task reads are reduced to a forest first, which is all there is to do for a small table. Large and small
    stars then take turns until a round changes nothing, some log n rounds. A step is an aggregate, combined
    before its shuffle, and a join; no task holds the links of a node together. Each round is a written table.
    """
    def mark(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    held = step(_ordered(links.select("a", "b").where("a is not null and b is not null").mapInArrow(_within_tasks, "a long, b long")), "links")
    held = step(held.mapInArrow(_within_tasks, "a long, b long"), "links")
    before = mark(held)
    while before[0]:
        held = step(_star(_star(held, large=True), large=False), "links")
        after = mark(held)
        if after == before:
            break
        before = after
    roots = held.select("b").distinct().select(F.col("b").alias("id"), F.col("b").alias("component"))
    return held.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
