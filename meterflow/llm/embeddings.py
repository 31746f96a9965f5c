"""Near-duplicate vectors: an inverted multi-index over two codebooks, nearest cells first, verified by cosine."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .store import step

THRESHOLD = 0.98
SAMPLE = 20_000
PER_CELL = 512
MAX_CODES = 256
TARGET_RECALL = 1.0
BLOCK = 4_096
SEED = 7


@dataclass
class Codebooks:
    """Centres of the two halves, and the squared reach up to which cells are visited."""
    halves: tuple[np.ndarray, np.ndarray]
    reach: float

    def bounds(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each half, squared lower bounds of the distance from each vector to what a centre is nearest to."""
        found, split = [], self.halves[0].shape[1]
        for centres, part in zip(self.halves, (unit[:, :split], unit[:, split:])):
            d2 = np.maximum(0, (part ** 2).sum(1)[:, None] - 2 * part @ centres.T + (centres ** 2).sum(1))
            own = d2.argmin(1)
            apart = np.sqrt(np.maximum(0, ((centres[:, None] - centres) ** 2).sum(2)))[own]
            bound = np.divide(d2 - d2[np.arange(len(part)), own][:, None], 2 * apart, out=np.zeros_like(d2), where=apart > 0)
            found.append(np.maximum(bound, 0) ** 2)
        return found

    def needed(self, asking: np.ndarray, linked: np.ndarray) -> np.ndarray:
        """The reach at which each asking vector visits the home of the linked one."""
        return sum(bound[np.arange(len(linked)), home.argmin(1)] for bound, home in zip(self.bounds(asking), self.bounds(linked)))

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cell of each vector, and (vector, cell) of each cell visited: those whose two bounds sum to no more than
        the reach, found by walking both halves in the order of their bounds. Of two cells only one is visited from the other."""
        first, second = self.bounds(unit)
        codes = len(self.halves[1])
        home = first.argmin(1) * codes + second.argmin(1)
        order = np.argsort(second, axis=1)
        ranked = np.take_along_axis(second, order, 1)
        vectors, cells = [], []
        for code in range(first.shape[1]):
            left = self.reach - first[:, code]
            count = (ranked <= left[:, None]).sum(1)
            own = np.repeat(np.arange(len(unit)), count)
            rank = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            vectors.append(own)
            cells.append(code * codes + order[own, rank])
        vector, cell = np.concatenate(vectors), np.concatenate(cells)
        mine = home[vector]
        kept = (cell == mine) | ((cell < mine) == ((cell + mine) % 2 == 0))
        return home, vector[kept], cell[kept]


def _kmeans(points: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = points[np.sort(rng.choice(len(points), min(codes, len(points)), replace=False))].copy()
    for _ in range(rounds):
        own = ((centres ** 2).sum(1) - 2 * points @ centres.T).argmin(1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return np.unique(centres, axis=0)


def _unit(column, width: int) -> np.ndarray:
    """Vectors as rows of doubles of length 1, shorter ones padded with zeros. Scaled first: components may be very large or small."""
    lengths = np.asarray(column.value_lengths())
    matrix = np.zeros((len(lengths), width))
    if len(lengths):
        matrix[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True, initial=1e-300)
    return matrix / np.sqrt((matrix ** 2).sum(1, keepdims=True))


def fit(vectors: DataFrame, rows: int, width: int, threshold: float, target_recall: float, sample: int = SAMPLE) -> Codebooks:
    """Codebooks fitted on at most ``sample`` vectors, those with the least hash.

    The reach is the ``target_recall`` quantile of what is needed, over vectors of the sample and links to them at
    the very threshold in random directions, and over the links inside the sample. With a target of 1 it is the square of the
    distance of linked vectors, sqrt(2 - 2 * threshold), so that every cell that can hold one is visited.
    """
    picked = vectors.orderBy("h1", "h2").limit(sample).select("label", "v").toArrow()
    unit = _unit(picked["v"].combine_chunks(), width)
    codes = int(np.clip(np.sqrt(rows / PER_CELL), 4, MAX_CODES))
    split = max(1, width // 2)
    books = Codebooks((_kmeans(unit[:, :split], codes), _kmeans(unit[:, split:], codes)), 2 - 2 * threshold + 1e-9)
    if target_recall < 1:
        rng = np.random.default_rng(SEED)
        ask = unit[rng.choice(len(unit), min(len(unit), 4_000), replace=False)]
        away = rng.standard_normal(ask.shape)
        away -= (away * ask).sum(1, keepdims=True) * ask
        away *= np.sqrt(1 - threshold ** 2) / np.maximum(np.sqrt((away ** 2).sum(1, keepdims=True)), 1e-300)
        needed = [books.needed(ask, threshold * ask + away)]
        label = picked["label"].to_numpy()
        for begin in range(0, len(unit), 512):
            rows_, other = np.nonzero((unit[begin:begin + 512] @ unit.T >= threshold) & (label[begin:begin + 512, None] == label))
            own = rows_ + begin != other
            if own.any():
                needed.append(books.needed(unit[begin + rows_[own]], unit[other[own]]))
        books.reach = min(books.reach, max(float(np.quantile(x, target_recall)) for x in needed[:1] + [np.concatenate(needed)]))
    return books


def _visits(vectors: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """A row for each cell a vector visits; ``home`` where it lies in it."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2_000):
                part = batch.slice(begin, 2_000)
                home, vector, cell = books.cells(_unit(part.column("v"), width))
                extra = part.select(["label", "rep", "copies", "v"]).take(pa.array(vector))
                yield pa.RecordBatch.from_arrays([*extra.columns, pa.array(cell.astype(np.int64)), pa.array(home[vector] == cell)],
                                                 ["label", "rep", "copies", "v", "cell", "home"])

    return vectors.select("label", "rep", "copies", "v").mapInArrow(rows, f"label string, rep long, copies long, v {vectors.schema['v'].dataType.simpleString()}, cell long, home boolean")


def _least(mask: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.where(mask, values, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)


def _linked(table: pa.Table, width: int, threshold: float) -> pa.Table:
    """For the vectors of a block: copies of linked vectors, and the least vector they hang together with. A visitor counts those at home in
    it; these count the visitors from other cells, which they do not visit themselves."""
    home = table["home"].to_numpy()
    unit = _unit(table["v"].combine_chunks(), width)
    rep, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
    visitor = table["visits"].to_numpy()
    own, mine = unit[home], unit[visitor]
    masks = [np.packbits((mine[i:i + 512] @ own.T >= threshold) & (rep[visitor][i:i + 512, None] != rep[home]), axis=1)
             for i in range(0, len(mine), 512)]
    mask = lambda k: np.unpackbits(masks[k], axis=1, count=len(own)).astype(bool)
    links = np.concatenate([mask(k) @ copies[home] for k in range(len(masks))]) if masks else np.empty(0, np.int64)
    foreign = np.where(table["here"].to_numpy()[visitor], 0, copies[visitor])
    met = sum((foreign[512 * k:512 * k + 512] @ mask(k) for k in range(len(masks))), np.zeros(len(own), np.int64))
    ids, place = np.unique(rep, return_inverse=True)
    root, changed = ids.copy(), True
    while changed and len(own):
        before = root.copy()
        for k in range(len(masks)):
            at, m = place[visitor][512 * k:512 * k + 512], mask(k)
            np.minimum.at(root, at, _least(m, root[place[home]]))
            np.minimum.at(root, place[home], _least(m.T, root[at]))
        changed = bool((root != before).any())
    both = [np.concatenate(x) for x in ((rep[visitor], rep[home]), (links, met), (root[place[visitor]], root[place[home]]))]
    return pa.table({name: pa.array(x.astype(np.int64)) for name, x in zip(("rep", "links", "root"), both)})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, id_column: str = "vec_id",
                    vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per vector: ``vec_id``, ``n_links`` (other vectors of its label with a cosine of at least ``threshold``),
    ``component_id`` (least id that links lead to) and ``kept`` (whether that is its own).

    Equal vectors of a label are one entry with a count. Entries visit cells of the multi-index, where only entries of
    the same label and length are compared, in blocks of at most some ``BLOCK`` entries, so that a
    crowded cell becomes many tasks; blocks give sums and roots, never pairs. By default no link is missed. A lower target recall visits fewer cells;
    its reach rests on a sample, and on large tables more links may be missed than it says. Vectors that are null, empty or zero, or have null or
    non-finite components, a null label or a null id, link with nothing. Rows repeated with an id count once.
    """
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    numbers = F.col(vector) if single else F.col(vector).cast("array<double>")
    sound = (F.col(id_column).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
             & F.forall(numbers, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(numbers, lambda x: x != 0))
    own = vectors.select(F.col(id_column).cast("long").alias("vec_id"), numbers.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"),
                         F.concat(F.col(label).cast("string"), F.lit("/"), F.size(vector).cast("string")).alias("label"))
    own = own.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(SEED), "v")})
    ids = own.where("sound").select("vec_id", "label", "h1", "h2").distinct()
    counts = ids.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    entries = own.where("sound").groupBy("label", "h1", "h2").agg(F.any_value("v").alias("v")).join(counts, ["label", "h1", "h2"])
    entries = step(entries, "entries")
    size = entries.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width")).first()
    nothing = own.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                            F.col("vec_id").isNotNull().alias("kept")).distinct()
    if not size["rows"]:
        return nothing
    width = size["width"]
    visits = step(_visits(entries, fit(entries, size["rows"], width, threshold, target_recall), width), "visits")
    crowds = visits.groupBy("label", "cell").agg(F.ceil(F.count_if("home") / BLOCK).alias("homes"), F.ceil(F.count("*") / BLOCK).alias("blocks")).where("homes > 0")
    placed = visits.join(crowds, ["label", "cell"]).withColumn("here", F.col("home"))
    share = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    single = placed.where("homes = 1 and blocks = 1").select("*", F.lit(True).alias("visits"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    crowded = placed.where("homes > 1 or blocks > 1")
    asking = crowded.select("*", F.lit(True).alias("visits"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("homes") - 1)).alias("s"), share("blocks").alias("t")).withColumn("home", F.lit(False))
    held = crowded.where("home").select("*", F.lit(False).alias("visits"), share("homes").alias("s"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("t"))
    dealt = single.unionByName(asking).unionByName(held).select("label", "cell", "s", "t", "rep", "copies", "v", "home", "here", "visits")

    def linked(table: pa.Table) -> pa.Table:
        return _linked(table, width, threshold)

    found = step(dealt.groupBy("label", "cell", "s", "t").applyInArrow(linked, "rep long, links long, root long").where("links > 0"), "found")
    links = found.groupBy(F.col("rep").alias("_rep")).agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    entry = entries.select("label", "h1", "h2", "rep", "copies")
    classes = (entry.join(links, F.col("rep") == F.col("_rep"), "left").join(joined.withColumnRenamed("id", "_id"), F.col("rep") == F.col("_id"), "left")
               .select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    return ids.join(classes, ["label", "h1", "h2"]).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).unionAll(nothing)


def op6_multi_index(spark, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with recursive e as (select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from e a join e b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
          where list_cosine_similarity(a.v, b.v) >= 0.98),
reach as (select vec_id as id, vec_id as low from embeddings union select l.a, r.low from reach r join links l on l.b = r.id),
least as (select id, min(low) as component_id from reach group by id)
select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id, vec_id = component_id as kept
from embeddings join least on id = vec_id"""
