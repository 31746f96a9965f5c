"""Near-duplicate documents: a Jaccard join on word shingles by signature trees."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .chunks import Words, mix, rolling, texts_in_chunks
from .components import components
from .store import small_batches, step

SHINGLE = 5
#: Shingles that are ordered last, so that prefixes avoid them; bounds what is sent to every task.
COMMON = 1 << 18
COMMON_FROM = 8
TREE_BITS = 2048
MAX_BITS = 1 << 16
FAN = 8
BLOCK = 16_384
TRIED = 6
#: Shingles that a class carries along, by which pairs met under another one are known.
CARRIED = 8
MARKS = 1 << 24
#: Pairs that a task goes down a tree with, or tells apart, at a time, and pairs of signatures it holds side by side.
PAIRS_AT_ONCE = 100_000
SIGNATURES_AT_ONCE = 8_192
#: Bytes of text whose words and shingles are told apart at a time.
AT_ONCE = 1 << 18


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after the other; and how many each has. Made from some ``AT_ONCE`` bytes at a time."""
    parts, own, held = [], [], 0
    for t in texts:
        if own and held + len(t) > AT_ONCE:
            parts.append(_shingled(own, size))
            own, held = [], 0
        own.append(t)
        held += len(t)
    if not parts:
        return _shingled(own, size)
    values, counts = zip(*parts, _shingled(own, size))
    return np.concatenate(values), np.concatenate(counts)


def _shingled(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts, lower=True)
    hashes, first = words.windows(size)
    text = words.text_of()[first]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        own = [rolling(words.hash[words.first[i]:words.first[i + 1]], int(words.count[i])) for i in short]
        hashes, text = np.concatenate([hashes, *own]), np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.bincount(text[new], minlength=len(texts))


def _of(values: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    ends = np.cumsum(counts)
    for end, count in zip(ends.tolist(), counts.tolist()):
        yield values[end - count:end]


def bitmap(own: np.ndarray, bits: int) -> bytes:
    """Bit i of ``bits`` (a power of two) is set if a shingle falls there; with half the bits, neighbours are combined."""
    marks = np.zeros(bits, bool)
    marks[(mix(own) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def own_bits(n: int) -> int:
    return min(MAX_BITS, max(64, 1 << int(n).bit_length()))


def classes_of(own: np.ndarray) -> int:
    """One number for a set: two sets share it with odds of about 2 ** -64."""
    return int(mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))


def _prefixes(n: int) -> tuple[int, int]:
    """How many shingles, in one order for all sets, hold a shared one if a set of n links with a set not smaller, or with any.

    A link needs 7 * shared >= 3 * (n + m), which is 6/7 of n if m >= n, and 3/4 of n in any case.
    """
    return n + (-6 * n) // 7 + 1, n + (-3 * n) // 4 + 1


def _documents(docs: DataFrame) -> DataFrame:
    """Per row: id, document, its set's class, size and bitmaps; no class without words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text"):
            values, counts = shingle_sets(texts)
            sets = list(_of(values, counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("doc"), pa.array([classes_of(s) if len(s) else None for s in sets], pa.int64()), pa.array(counts),
                 pa.array([bitmap(s, own_bits(len(s))) if len(s) else None for s in sets], pa.binary()),
                 pa.array([bitmap(s, TREE_BITS) if len(s) else None for s in sets], pa.binary())], ["id", "doc", "class", "n", "bits", "tree"])

    return docs.select("id", "doc", "text").mapInArrow(rows, "id long, doc long, class long, n long, bits binary, tree binary")


def _distinct(sets: list[np.ndarray]) -> dict[int, np.ndarray]:
    return {classes_of(s): s for s in sets if len(s)}


def _common(docs: DataFrame) -> np.ndarray:
    """At most ``COMMON`` shingles that occur in several different sets of a chunk, those counted most often."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in texts_in_chunks(batches, "text"):
            sets = list(_distinct(list(_of(*shingle_sets(texts)))).values())
            if sets:
                value, count = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value[count > 1].view(np.int64)), pa.array(count[count > 1])], ["shingle", "n"])

    counted = docs.select("text").mapInArrow(rows, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    most = counted.where(F.col("n") >= COMMON_FROM).orderBy(F.desc("n"), "shingle").limit(COMMON)
    return np.sort(np.array([r["shingle"] for r in most.collect()], np.int64).view(np.uint64))


def _entries(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """The prefix of every set: shingle, class, size, and whether the shingle is in the prefix for partners not smaller."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in texts_in_chunks(batches, "text"):
            found = []
            for own_class, own in _distinct(list(_of(*shingle_sets(texts)))).items():
                place = np.searchsorted(common, own)
                last = np.append(common, np.uint64(0))[place] == own if len(common) else np.zeros(len(own), bool)
                early, late = _prefixes(len(own))
                picked = np.concatenate([own[~last], own[last]])[:late]
                found.append((picked, np.full(len(picked), own_class), np.full(len(picked), len(own)), np.arange(len(picked)) < early))
            if found:
                shingle, own_class, n, early = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(own_class), pa.array(n.astype(np.int32)), pa.array(early)],
                                                 ["shingle", "class", "n", "early"])

    return docs.select("text").mapInArrow(rows, "shingle long, class long, n int, early boolean")


def _across(rows: DataFrame, value: str) -> DataFrame:
    """Rows whose shingle has several values."""
    own = Window.partitionBy("shingle")
    return (rows.withColumns({"_low": F.min(value).over(own), "_high": F.max(value).over(own)})
            .where(F.col("_low") != F.col("_high")).drop("_low", "_high"))


def _few(shared: DataFrame) -> DataFrame:
    """A few of the shared shingles of every class: those with the least hash, which are the same ones for most of its near copies."""
    by_class = Window.partitionBy("class").orderBy(F.xxhash64("shingle"), "shingle")
    few = shared.withColumn("_place", F.row_number().over(by_class)).where(F.col("_place") <= TRIED).drop("_place")
    return few.withColumn("component", F.col("class"))


def _told_apart(entries: DataFrame) -> DataFrame:
    """Without shingles that have the very members of another one: near copies share whole runs of them, and each would give the same pairs."""
    member = F.xxhash64("class", "early").cast("decimal(38,0)")
    groups = entries.groupBy("shingle").agg(F.sum(member).alias("members"), F.count("*").alias("n"))
    one = groups.groupBy("members", "n").agg(F.min("shingle").alias("shingle")).select("shingle")
    return entries.join(one, "shingle", "left_semi")


def _carried(entries: DataFrame) -> DataFrame:
    """Per class the least of its shingles, and which of them are early."""
    least = F.slice(F.sort_array(F.collect_list(F.struct("shingle", "early"))), 1, CARRIED)
    return entries.groupBy("class").agg(least.alias("least")).select("class", F.col("least.shingle").alias("least"), F.col("least.early").alias("least_early"))


def _padded(lists: pa.ChunkedArray, otherwise) -> np.ndarray:
    """Lists of at most ``CARRIED`` values as rows of a matrix."""
    lists = lists.combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy()
    out = np.full((len(lengths), CARRIED), otherwise)
    out[np.arange(CARRIED) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Tree:
    """Members in the order of their sizes; ``FAN`` nodes make one of the next level. A node has the range of its
    members' sizes and components, the bitmaps of all combined, and the most shingles that share a bit with another in one member."""

    def __init__(self, n: np.ndarray, component: np.ndarray, bits: np.ndarray):
        hidden = n - np.bitwise_count(bits).sum(1)
        self.levels = [(n, n, component, component, bits, hidden)]
        while len(self.levels[-1][0]) > FAN:
            low, high, least, most, union, rest = self.levels[-1]
            starts = np.arange(0, len(low), FAN)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.minimum.reduceat(least, starts),
                                np.maximum.reduceat(most, starts), np.bitwise_or.reduceat(union, starts, axis=0), np.maximum.reduceat(rest, starts)))

    def _common(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bits two nodes have in common."""
        union, out = self.levels[level][4], np.empty(len(a), np.int64)
        for i in range(0, len(a), SIGNATURES_AT_ONCE):
            own = slice(i, i + SIGNATURES_AT_ONCE)
            out[own] = np.bitwise_count(union[a[own]] & union[b[own]]).sum(1)
        return out

    def _below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of ``level`` under pairs of nodes of the level above, each under a with each under b."""
        size = len(self.levels[level][0])
        a, b = (np.repeat(a * FAN, FAN * FAN) + np.tile(np.repeat(np.arange(FAN), FAN), len(a)),
                np.repeat(b * FAN, FAN * FAN) + np.tile(np.tile(np.arange(FAN), FAN), len(b)))
        inside = (a < size) & (b < size)
        return a[inside], b[inside]

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a member of node a and one of node b can link: not all of one component, sizes within reach, and the
        overlap that the common bits allow is enough for the smallest members."""
        low, high, least, most, _, rest = self.levels[level]
        one = (least[a] == most[a]) & (least[b] == most[b]) & (least[a] == least[b])
        reach = (4 * high[a] >= 3 * low[b]) & (4 * high[b] >= 3 * low[a])
        left = np.flatnonzero(~one & reach)
        a, b = a[left], b[left]
        overlap = np.minimum(np.minimum(high[a], high[b]), self._common(level, a, b) + np.minimum(rest[a], rest[b]))
        found = np.zeros(len(one), bool)
        found[left[7 * overlap >= 3 * (low[a] + low[b])]] = True
        return found

    def _overlap(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest part of two nodes' smallest members that can be shared."""
        low, high, _, _, _, rest = self.levels[level]
        return np.minimum(np.minimum(high[a], high[b]), self._common(level, a, b) + np.minimum(rest[a], rest[b])) / (low[a] + low[b])

    def partners(self) -> tuple[np.ndarray, np.ndarray]:
        """At most two pairs a member that may link: with the member whose signature overlaps most, found by going down both sides of
        the tree with the ``FAN`` best partners of every node, and with the most typical member, whose signature has the bits that most have."""
        top = len(self.levels[-1][0])
        found, left = [], [(len(self.levels) - 1, *(x.ravel() for x in np.indices((top, top))), False)]
        while left:
            level, a, b, above = left.pop()
            if above:
                a, b = self._below(level, a, b)
            kept = self.may_link(level, a, b) if level else (a != b) & self.may_link(level, a, b)
            a, b = a[kept], b[kept]
            order = np.lexsort((b, -self._overlap(level, a, b), a))
            a, b = a[order], b[order]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            few = place < (FAN if level else 1)
            a, b = a[few], b[few]
            if not level:
                found.append((a, b))
                continue
            # all partners of a node go down together
            nodes = np.flatnonzero(np.diff(a, prepend=-1))[::max(1, PAIRS_AT_ONCE // FAN ** 3)].tolist()
            left.extend((level - 1, a[i:j], b[i:j], True) for i, j in zip(nodes, [*nodes[1:], len(a)]))
        others, typical = self._typical()
        return np.concatenate([*(f[0] for f in found), others]), np.concatenate([*(f[1] for f in found), np.full(len(others), typical)])

    def _typical(self) -> tuple[np.ndarray, int]:
        """The member whose signature has the bits that most have, and the members that may link with it."""
        bits = self.levels[0][4].view(np.uint8)
        counts = sum(np.unpackbits(bits[i:i + SIGNATURES_AT_ONCE], axis=1).sum(0, dtype=np.int64) for i in range(0, len(bits), SIGNATURES_AT_ONCE))
        most = np.packbits(counts * 2 > len(bits))
        typical = int(np.argmax(np.bitwise_count(bits & most).sum(1, dtype=np.int64) * 2 - np.bitwise_count(bits).sum(1, dtype=np.int64)))
        others = np.delete(np.arange(len(bits)), typical)
        return others[self.may_link(0, others, np.full(len(others), typical))], typical

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Members that may link, all at once."""
        a, b = zip(*self.some_pairs(), (np.empty(0, np.int64), np.empty(0, np.int64)))
        return np.concatenate(a), np.concatenate(b)

    def some_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Members that may link, by going down both sides of the tree at once, at most ``PAIRS_AT_ONCE`` pairs of nodes at a time to the bottom."""
        top = len(self.levels[-1][0])
        left = [(len(self.levels) - 1, *(x.ravel() for x in np.indices((top, top))), False)]
        while left:
            level, a, b, above = left.pop()
            if above:
                a, b = self._below(level, a, b)
            ahead = a <= b if level else a < b
            a, b = a[ahead], b[ahead]
            kept = self.may_link(level, a, b)
            a, b = a[kept], b[kept]
            if not level:
                yield a, b
                continue
            some = max(1, PAIRS_AT_ONCE // FAN ** 2)
            left.extend((level - 1, a[i:i + some], b[i:i + some], True) for i in range(0, len(a), some))


def _batch_of(pairs: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _tree_pairs(grouped: DataFrame, best: bool = False) -> DataFrame:
    """Pairs of classes of different components that may link, from rows (key, shingle, class, n, early, component, tree): all, or for the
    members of large groups the ``best`` ones. Where all are asked for, rows have what ``_carried`` gives, and a pair that also meets
    under a lesser one of those shingles is left to that one.
    """
    parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pairs_of(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        own, n, early, component = (table[c].to_numpy() for c in ("class", "n", "early", "component"))
        bits = np.frombuffer(b"".join(table["tree"].to_pylist()), np.uint64).reshape(-1, TREE_BITS // 64)
        n = n.astype(np.int64)
        sizes = ends - starts
        if not best:
            shingle, least, least_early = table["shingle"].to_numpy(), _padded(table["least"], np.iinfo(np.int64).max), _padded(table["least_early"], False)

        def met(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            """Whether pairs of members also meet under a lesser shingle that they carry."""
            same = (least[x][:, :, None] == least[y][:, None, :]) & (least[x] < shingle[x][:, None])[:, :, None]
            return (same & (least_early[x][:, :, None] | (least_early[y][:, None, :] & (n[x] == n[y])[:, None, None]))).any((1, 2))

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            flat = np.repeat(sizes <= FAN, sizes)
            # small groups: each member with all after it, for all groups at once
            place = np.flatnonzero(flat) + starts[0]
            count = np.repeat(ends, sizes)[flat] - place - 1
            a = np.repeat(place, count)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
            if len(a):
                kept = Tree(n, component, bits).may_link(0, a, b)
                yield a[kept], b[kept]
            for begin, end in zip(starts[sizes > FAN].tolist(), ends[sizes > FAN].tolist()):
                tree = Tree(n[begin:end], component[begin:end], bits[begin:end])
                for a, b in [tree.partners()] if best else tree.some_pairs():
                    yield a + begin, b + begin

        def wanted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for a, b in found():
                a, b = np.minimum(a, b), np.maximum(a, b)
                if not best:
                    kept = early[a] | (early[b] & (n[a] == n[b]))
                    a, b = a[kept], b[kept]
                    kept = np.ones(len(a), bool)
                    for i in range(0, len(a), SIGNATURES_AT_ONCE):
                        kept[i:i + SIGNATURES_AT_ONCE] = ~met(a[i:i + SIGNATURES_AT_ONCE], b[i:i + SIGNATURES_AT_ONCE])
                    a, b = a[kept], b[kept]
                yield np.minimum(own[a], own[b]), np.maximum(own[a], own[b])

        held, count = [], 0
        for pair in wanted():
            held.append(np.stack(pair))
            count += len(pair[0])
            if count >= PAIRS_AT_ONCE:
                yield _batch_of(held)
                held, count = [], 0
        if count:
            yield _batch_of(held)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if held[0].column("key")[0] == batch.column("key")[-1]:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield from pairs_of(table, starts[:-1], starts[1:])
            held = table.slice(int(starts[-1])).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield from pairs_of(table, starts, np.append(starts[1:], len(key)))

    ordered = grouped.repartition(parts, "key").sortWithinPartitions("key", "n", "class")
    return ordered.mapInArrow(rows, "a long, b long").distinct()


def _dealt(entries: DataFrame) -> DataFrame:
    """Key the members of a shingle by it; a shingle of more than ``BLOCK`` members is dealt as pairs of blocks."""
    sizes = entries.groupBy("shingle").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    marked = entries.join(sizes, "shingle", "left")
    one = marked.where("blocks is null").withColumn("key", F.col("shingle")).drop("blocks")
    mine = F.pmod(F.xxhash64("class"), F.col("blocks"))
    many = (marked.where("blocks is not null").withColumn("_mine", mine)
            .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("key", F.xxhash64("shingle", F.least("_mine", "_other"), F.greatest("_mine", "_other"))).drop("blocks", "_mine", "_other"))
    return one.unionByName(many)


def _mark(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(MARKS))


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``MARKS`` bits with those of the ids set: what is not marked is not wanted. Its size does not depend on the table."""
    bit = ids.select((_mark("doc") + 1).alias("bit"))
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    marks = np.zeros(MARKS // 8, np.uint8)
    for row in parts:
        own = np.frombuffer(row["bits"], np.uint8)
        marks[(row["part"] - 1) * len(own):row["part"] * len(own)] = own
    return marks


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that link. Those whose bitmaps rule it out go first; then the sets of the others are read and compared."""
    def by_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))):
                x, y = (np.frombuffer(v, np.uint8) for v in (x, y))
                while len(x) != len(y):
                    long, short = (x, y) if len(x) > len(y) else (y, x)
                    halved = np.packbits(np.bitwise_or.reduce(np.unpackbits(long).reshape(-1, 2), axis=1))
                    x, y, n, m = (halved, short, n, m) if long is x else (short, halved, n, m)
                both, own, other = (int(np.bitwise_count(v).sum()) for v in (x & y, x, y))
                overlap = min(n - own + both, m - other + both)
                keep.append(4 * min(n, m) >= 3 * max(n, m) and 7 * overlap >= 3 * (n + m))
            yield batch.select(["a", "b", "rep_a", "rep_b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: classes.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "n", "bits")])
    left = step(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "rep_a", "rep_b", "n_a", "n_b", "bits_a", "bits_b")
                .mapInArrow(by_bits, "a long, b long, rep_a long, rep_b long"), "candidates")
    wanted = step(left.select(F.col("rep_a").alias("doc")).unionAll(left.select(F.col("rep_b").alias("doc"))).distinct(), "wanted")
    marks = _marks(wanted)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = batch.column("mark").to_numpy()
            own = batch.filter(pa.array(marks[mark >> 3] >> (mark & 7) & 1 == 1))
            for part, texts in texts_in_chunks([own], "text"):
                found = [s.tobytes() for s in _of(*shingle_sets(texts))]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(found, pa.binary())], ["doc", "own"])

    marked = docs.select("doc", "text", _mark("doc").alias("mark"))
    read = marked.mapInArrow(sets, "doc long, own binary").join(wanted, "doc", "left_semi").groupBy("doc").agg(F.max("own").alias("own"))
    read = step(read, "sets")

    def by_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("own_a"), batch.column("own_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(7 * shared >= 3 * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = lambda x: read.select(F.col("doc").alias(f"rep_{x}"), F.col("own").alias(f"own_{x}"))
    return step(left.join(own("a"), "rep_a").join(own("b"), "rep_b").select("a", "b", "own_a", "own_b").mapInArrow(by_sets, "a long, b long"), "links")


def link_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``, the least id reachable over links, itself included.

    Two documents link if 100 * shared >= 75 * all of their distinct five-word shingles (fewer words: all as one). Equal
    sets are one class. Linked sets share a shingle of their prefixes in one order of all shingles, the common ones last. Classes that share
    one stand in a signature tree. Its best partners are verified first, which ties most near copies; then, where several components
    are left under a shingle, both sides of its tree are descended once more, leaving out pairs of nodes that are tied or cannot
    link. Every pair that is left is verified on whole sets, so no link is lost and none is made up but for equal 64-bit hashes.
    Documents without words or text link with nothing. A document is an id with a text: rows that repeat both give one row, two
    texts under one id give two, and rows without an id link like others (a group without any id has a null ``component_id``).
    """
    with small_batches(docs.sparkSession):
        return _linked(docs, id_column, text)


def _linked(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    own = read.withColumn("doc", F.xxhash64("id", "text"))
    table = step(_documents(own), "documents")
    classes = step(table.where("class is not null").groupBy("class").agg(
        F.min("doc").alias("rep"), F.max("n").alias("n"), F.max("bits").alias("bits"), F.max("tree").alias("tree"), F.min("id").alias("low")), "classes")
    signatures = classes.select("class", "tree")
    shared = step(_across(_entries(own, _common(own)), "class").distinct(), "shared")
    first = _verified(_tree_pairs(_dealt(step(_few(shared), "few")).join(signatures, "class"), best=True), classes, own)
    tied = step(components(first), "tied")
    labelled = shared.join(tied.withColumnRenamed("id", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    apart = step(_told_apart(step(_across(labelled, "component"), "apart")), "told_apart")
    second = _verified(_tree_pairs(_dealt(apart).join(signatures, "class").join(_carried(apart), "class")), classes, own)
    joined = components(first.unionAll(second)).withColumnRenamed("id", "class")
    reached = classes.select("class", "low").join(joined, "class")
    least = reached.groupBy("component").agg(F.min("low").alias("least"))
    of_class = classes.select("class", "low").join(reached.select("class", "component"), "class", "left").join(least, "component", "left")
    return table.select("id", "doc", "class", "n").distinct().join(of_class, "class", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("least", "low", "id").alias("component_id"))


def op4_signature_trees(spark, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
with recursive d as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingles as (select distinct doc_id, array_to_string(w[i + 1:i + 5], ' ') as s from (select *, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) as i from d)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select doc_id as id, doc_id as low from documents union select l.a, r.low from reach r join both_ways l on l.b = r.id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, low as component_id
from (select id as doc_id, min(low) as low from reach group by id) left join sizes using (doc_id)"""
