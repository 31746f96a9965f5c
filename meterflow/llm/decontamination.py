"""Benchmark passages in documents: SimHash windows of the items' sizes and of runs of their words, looked up by Hamming
blocks and verified on weighted shingles."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chunks import Words, rolling, texts_in_chunks
from .store import step

RADIUS = 5
STRIDE = 4
LADDER = 1.25
SHORT = 10
SHINGLE = 5
THRESHOLD = 0.75
#: Words of a window inside an item, and its radius (see ``run_size``).
RUN = 13
RUN_RADIUS = 3
ITEMS_PER_PASS = 20_000
CHUNK_BYTES = 1 << 19

#: A-Z to a-z; what is no letter, digit or part of a non-ASCII character to a space.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    """The words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text, with only spaces between them."""
    return text.translate(PLAIN)


def window_size(length: int) -> tuple[int, int]:
    """Words in the window of an item of ``length`` words, and the stride at which documents are read for it.

    Sizes are steps of a ladder, so that items of many lengths share few of them; the window is so much shorter than the
    item that wherever a copy of the item begins, a document window at a multiple of the stride lies in it.
    """
    if length < SHORT + STRIDE - 1:
        return length, 1
    size = SHORT
    while int(size * LADDER) <= length - STRIDE + 1:
        size = int(size * LADDER)
    return size, STRIDE


def run_size(length: int) -> tuple[int, int, int]:
    """Words in the windows at every place of an item, the stride at which documents are read for them, and the number of those places.

    A copy with a similarity of 3/4 lacks at most a seventh of the item's n shingles, so at most n / 35 words inside of it have
    changed, and of the stretches between them one has some 30 n / (n + 35) shingles, 17 words or more from an item of 20 words on. Such
    a stretch holds a document window of ``RUN`` words at a multiple of the stride, which is met at distance 0. Items of fewer than 17
    words can have lost a word at one end, those of fewer than 11 none.
    """
    size, stride = (RUN, STRIDE) if length >= RUN + STRIDE else (length - STRIDE, STRIDE) if length >= RUN else (length - 1, 1) if length >= 11 else (length, 1)
    return size, stride, length - size + 1


def bit_sums(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Running counts of set bits of the word hashes, one row per bit. They wrap around in the smallest type that tells
    the counts of ``longest`` words apart."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((64, len(hashes) + 1), np.min_scalar_type(2 * longest))
    np.cumsum(np.ascontiguousarray(bits.T), axis=1, out=sums[:, 1:], dtype=sums.dtype)
    return sums


def fingerprints(sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` words from each start: the majority of each bit."""
    counts = sums.take(starts + size, axis=1)
    counts -= sums.take(starts, axis=1)
    majority = counts > size // 2
    return np.ascontiguousarray(np.packbits(majority, axis=0).T).view(np.uint64).ravel()


class Blocks:
    """Fingerprints by blocks of bits. Two that differ in at most ``radius`` bits agree in one of ``radius`` + 1 blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, self.tables = prints, radius, []
        edges = np.linspace(0, 64, radius + 2).astype(int)
        for low, high in zip(edges[:-1], edges[1:]):
            keys = self._block(prints, low, high)
            order = np.argsort(keys, kind="stable")
            first = np.searchsorted(keys[order], np.arange((1 << (high - low)) + 1))
            self.tables.append((low, high, order, first))

    @staticmethod
    def _block(prints: np.ndarray, low: int, high: int) -> np.ndarray:
        return ((prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)

    def within(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (asked, held) places whose fingerprints differ in at most ``radius`` bits."""
        found = []
        for low, high, order, first in self.tables:
            keys = self._block(asked, low, high)
            counts = first[keys + 1] - first[keys]
            some = np.flatnonzero(counts)
            counts = counts[some]
            ends = np.cumsum(counts)
            if not len(ends):
                continue
            place = np.repeat(first[keys[some]] - ends + counts, counts) + np.arange(ends[-1])
            own, held = np.repeat(some, counts), order[place]
            near = np.bitwise_count(asked[own] ^ self.prints[held]) <= self.radius
            found.append(own[near] * len(self.prints) + held[near])
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles of some words; fewer words are one shingle."""
    return rolling(hashes, min(SHINGLE, len(hashes)))


class Items:
    """The benchmark items of one pass: shingles, their weights, and by window size the blocks of their fingerprints.

    A shingle weighs 1 / (number of different items of the whole benchmark that hold it): what many items share says little. ``shared``
    has the shingles that several hold, ascending, and by how many. Items of the same words are one, with several ids. An item has a window of about its own size, met
    within ``radius``, and the windows of ``RUN`` words at each of its places, met within ``RUN_RADIUS``.
    """

    def __init__(self, rows: list[tuple[int, bytes]], radius: int, threshold: float, shared: tuple[np.ndarray, np.ndarray] | None = None):
        by_words: dict[bytes, list[int]] = {}
        for number, text in rows:
            words = plain(text).split()
            if words:
                by_words.setdefault(b" ".join(words), []).append(number)
        self.ids, texts = list(by_words.values()), [words.split() for words in by_words]
        self.threshold = threshold
        self.length = [len(w) for w in texts]
        self.longest = max([max(window_size(n)[0], run_size(n)[0]) for n in self.length], default=1)
        hashes = [Words([b" ".join(words)], lower=False).hash for words in texts]
        #: by item: its different shingles, ascending, and how often it has each
        self.shingles = [np.unique(shingles(h), return_counts=True) for h in hashes]
        several, held_by = shared or (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.weight = []
        for own, _ in self.shingles:
            self.weight.append(np.ones(len(own)))
            if len(several):
                place = np.minimum(np.searchsorted(several, own), len(several) - 1)
                self.weight[-1] = 1 / np.where(several[place] == own, held_by[place], 1)
        self.total = [float((w * n).sum()) for w, (_, n) in zip(self.weight, self.shingles)]
        classes: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
        for item, own in enumerate(hashes):
            sums = bit_sums(own, self.longest)
            size, stride = window_size(len(own))
            run, run_stride, places = run_size(len(own))
            for kind, offsets in (((size, stride, radius), stride), ((run, run_stride, min(radius, RUN_RADIUS)), places)):
                prints = fingerprints(sums, np.arange(offsets), kind[0])
                classes.setdefault(kind, []).extend((int(p), item, o) for o, p in enumerate(prints))
        self.classes = [(size, stride, Blocks(np.array([r[0] for r in rows_], np.uint64), reach), np.array([r[1:] for r in rows_], np.int64))
                        for (size, stride, reach), rows_ in sorted(classes.items()) if reach >= 0]

    def similarity(self, item: int, other: np.ndarray) -> float:
        """Weighted Jaccard similarity of the item's shingles with others. A shingle that is not the item's weighs as much as those
        that are missing do on average: it stands in the place of one of them."""
        own, n = self.shingles[item]
        place = np.minimum(np.searchsorted(own, other), len(own) - 1)
        both = np.minimum(n, np.bincount(place[own[place] == other], minlength=len(own)))
        total, missing = self.total[item], int((n - both).sum())
        shared = float((self.weight[item] * both).sum())
        more = (total - shared) * (len(other) - int(both.sum())) / missing if missing else 0.0
        return shared / (total + more)

    def best(self, item: int, hashes: np.ndarray, low: int, high: int) -> tuple[float, int] | None:
        """The most similar, then first, place of the item among those from ``low`` to ``high`` in a text, if it is similar enough.

        The weight of all shingles there that the item holds bounds the similarity; places are tried from the highest bound down.
        """
        length = self.length[item]
        size, total = min(SHINGLE, length), self.total[item]
        if len(hashes) < length:
            found = self.similarity(item, shingles(hashes))
            return (found, 0) if found >= self.threshold else None
        own = self.shingles[item][0]
        grams = rolling(hashes[low:high + length], size)
        place = np.minimum(np.searchsorted(own, grams), len(own) - 1)
        sums = np.concatenate([[0.0], np.cumsum(np.where(own[place] == grams, self.weight[item][place], 0.0))])
        n = length - size + 1
        bound = np.round(np.minimum(1.0, (sums[n:] - sums[:-n]) / total), 9)
        best = None
        order = np.flatnonzero(bound >= self.threshold - 1e-8)
        for begin in order[np.argsort(-bound[order], kind="stable")].tolist():
            if best and bound[begin] <= best[0] - 1e-8 or best and best[0] >= 1.0 and best[1] <= low + begin:
                break
            found = self.similarity(item, grams[begin:begin + n])
            if found >= self.threshold and (best is None or (-found, low + begin) < (-best[0], best[1])):
                best = found, low + begin
        return best

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, float]]:
        """(text, item, first word, similarity) of the best verified place of each item in each text."""
        words = Words([plain(t) for t in texts], lower=False)
        counts, text = words.count, words.text_of()
        place = np.arange(len(words.hash)) - words.first[text]
        sums = bit_sums(words.hash, self.longest)
        length = np.array(self.length, np.int64)
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size, stride, blocks, entries in self.classes:
            starts = np.flatnonzero((place % stride == 0) & (place + size <= counts[text]))
            if not len(starts):
                continue
            own, held = blocks.within(fingerprints(sums, starts, size))
            if len(own):
                item, offset = entries[held].T
                met.append((text[starts[own]], item, place[starts[own]] - offset))
        if not met:
            return
        t, item, begin = (np.concatenate(x) for x in zip(*met))
        last = np.maximum(0, counts[t] - length[item])
        pairs, which = np.unique(t * len(length) + item, return_inverse=True)
        lows, highs = np.full(len(pairs), np.iinfo(np.int64).max), np.zeros(len(pairs), np.int64)
        begin = np.clip(begin, 0, last)
        np.minimum.at(lows, which, begin)
        np.maximum.at(highs, which, begin)
        for pair, low_, high_ in zip(pairs.tolist(), lows.tolist(), highs.tolist()):
            t, item = divmod(pair, len(length))
            found = self.best(item, words.hash[words.first[t]:words.first[t + 1]], low_, high_)
            if found:
                yield t, item, found[1], found[0]


def find_passages(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id",
                  item_text: str = "text", threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id``, ``item_id``, ``first_word``, ``n_words``, ``similarity``.

    A place of a document holds an item if the weighted Jaccard similarity of the shingles of the item and of as many words
    of the document is at least ``threshold``. Windows of a document that have the size of an item, and short ones, are hashed to 64 bits, and
    every pair of fingerprints within the radius of its size is tried: a copy with a stretch of ``RUN`` + 3 unchanged words is always met, as
    are shorter items that lost a word at an end. A document gives one row per
    item, at its most similar (then first) place. Documents and items without words, and null ids of items,
    give none; rows repeated in either table repeat in the result. Weights are counted over the whole benchmark, so that passes decide
    nothing. Documents are read once for each
    ``ITEMS_PER_PASS`` items, which are what is sent to every task.
    """
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, first_word long, n_words long, similarity double"
    result = docs.sparkSession.createDataFrame([], schema)
    for items in _passes(benchmark, item_column, item_text, radius, threshold):
        def found(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch, texts in texts_in_chunks(batches, "text", CHUNK_BYTES):
                ids = batch.column(0).to_pylist()
                rows = [(ids[t], item, begin, items.length[i], s) for t, i, begin, s in items.search(texts) for item in items.ids[i]]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     ["doc_id", "item_id", "first_word", "n_words", "similarity"])

        result = result.unionAll(chosen.mapInArrow(found, schema))
    return result


def _passes(benchmark: DataFrame, item_column: str, item_text: str, radius: int, threshold: float) -> Iterator[Items]:
    known = benchmark.where(F.col(item_column).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_column).cast("long").alias("item"), F.col(item_text).alias("words"))
    passes = -(-known.count() // ITEMS_PER_PASS)
    if not passes:
        return
    of_pass = F.pmod(F.xxhash64("item", "words"), F.lit(passes))
    grams = step(known.select(of_pass.alias("pass"), "words").mapInArrow(_shingles_of, "pass long, own long, shingle long"), "shingles")
    held = step(grams.select("own", "shingle").distinct().groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    for number in range(passes):
        part = known.where(of_pass == number).orderBy("item", "words").collect()
        found = grams.where(F.col("pass") == number).select("shingle").distinct().join(held, "shingle").toArrow()
        key = found["shingle"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        yield Items([(r["item"], r["words"].encode("utf-8", "replace")) for r in part], radius, threshold, (key[order], found["n"].to_numpy()[order]))


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different shingles of each item, with its pass and the hash of its words."""
    for batch in batches:
        for part, texts in texts_in_chunks([batch], "words", CHUNK_BYTES):
            for number, text in zip(part.column("pass").to_pylist(), texts):
                hashes = Words([plain(text)], lower=False).hash
                if len(hashes):
                    own, grams = rolling(hashes, len(hashes)).view(np.int64), np.unique(shingles(hashes)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), x)) for x in (number, own[0])] + [pa.array(grams)],
                                                     ["pass", "own", "shingle"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id", item_text: str = "text",
                      threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows, with all their columns, that ``find_passages`` would find no item in."""
    for items in _passes(benchmark, item_column, item_text, radius, threshold):
        def clean(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch, texts in texts_in_chunks(batches, text, CHUNK_BYTES):
                keep = np.ones(len(texts), bool)
                keep[[t for t, *_ in items.search(texts)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the items."""
    return find_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
