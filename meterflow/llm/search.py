"""Ranked lexical search: hashed max-sketches bound every score, and documents are scored exactly in the order of their bounds."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.storage import new_folder
from .chunks import Words, texts_in_chunks
from .shards import with_offsets
from .store import step

HASHES = 2               # sketches of a document, each by its own hash: a term's impact is bounded by the least of its coordinates
WIDTH_BITS = 12          # 2 ** WIDTH_BITS coordinates in each
STEP = 16                # impacts are kept in steps of 16, rounded up, so that 16 bits hold them
LENGTH_PCT = 75          # how much of a document's length counts against it
POSTINGS_AT_ONCE = 500_000
DOCS_AT_ONCE = 2_048
RESCORE = 32             # documents scored exactly at a time
TERMS_PER_BATCH = 200_000
NO_ID = -(1 << 63)


class Terms(Words):
    """Runs of letters, digits and non-ASCII characters of lower-cased texts."""

    _space = np.zeros(256, bool)
    _space[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def _postings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text with repeats (their number), where its own begin, its terms in order and how often each occurs."""
    words = Terms(texts, lower=True)
    known, local = np.unique(words.hash, return_inverse=True)
    pairs, tf = np.unique(words.text_of() * max(len(known), 1) + local, return_counts=True)
    text, term = np.divmod(pairs, max(len(known), 1))
    return words.count, np.searchsorted(text, np.arange(len(texts) + 1)), known[term], tf.astype(np.uint32)


def build_index(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n`` (its terms with repeats), ``terms`` (64-bit hashes in order) and ``tf``, as packed numbers.

    Written once, for any number of searches. Repeated rows are documents of their own; null and empty texts have no terms. Texts of
    any length are read whole; a task holds some 4 MB of them, or one longer text, at a time.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text"):
            count, first, terms, tf = _postings(texts)
            packed = [[x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])] for x in (terms, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), *(pa.array(p, pa.binary()) for p in packed)],
                                             ["doc_id", "n", "terms", "tf"])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return step(chosen.mapInArrow(rows, "doc_id long, n long, terms binary, tf binary"), "index")


class Block:
    """Some documents of the index, read into arrays."""

    def __init__(self, batch: pa.RecordBatch):
        columns = {c: batch.column(c) for c in batch.schema.names}
        self.ids = columns["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.n = columns["n"].to_numpy()
        terms = columns["terms"].to_pylist()
        self.terms = np.frombuffer(b"".join(terms), np.uint64)
        self.tf = np.frombuffer(b"".join(columns["tf"].to_pylist()), np.uint32).astype(np.int64)
        lengths = np.fromiter((len(t) // 8 for t in terms), np.int64, len(terms))
        self.doc = np.repeat(np.arange(len(terms)), lengths)

    def impacts(self, documents: int, total: int) -> np.ndarray:
        m = 100 - LENGTH_PCT + (LENGTH_PCT * self.n * documents) // total
        return (1_000_000_000 * self.tf) // (1000 * self.tf + 8 * m[self.doc])

    def sketches(self, impacts: np.ndarray) -> np.ndarray:
        """Per hash, coordinate and document the largest impact of the terms hashed there, in steps of ``STEP``, rounded up."""
        steps = ((impacts + STEP - 1) // STEP).astype(np.uint16)
        rising = np.argsort(steps, kind="stable")  # of several assignments to one place the last one stays
        terms, doc, steps = self.terms[rising], self.doc[rising], steps[rising]
        found = np.zeros((HASHES, 1 << WIDTH_BITS, len(self.ids)), np.uint16)
        for number, sketch in enumerate(found):
            sketch[coordinates(terms, number), doc] = steps
        return found


def coordinates(terms: np.ndarray, number: int) -> np.ndarray:
    return ((terms >> np.uint64(number * WIDTH_BITS)) & np.uint64((1 << WIDTH_BITS) - 1)).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Slices of the index with a bounded number of documents and postings (or one document)."""
    for batch in batches:
        sizes = [len(t) // 8 for t in batch.column("terms").to_pylist()]
        begin, held = 0, 0
        for i, size in enumerate([*sizes, None]):
            if i > begin and (size is None or held + size > POSTINGS_AT_ONCE or i - begin == DOCS_AT_ONCE):
                yield Block(batch.slice(begin, i - begin))
                begin, held = i, 0
            held += size or 0


class Batch:
    """Some queries: their different terms, and per query the places of its terms there with the number of repeats."""

    def __init__(self, rows: list):
        terms = [np.frombuffer(r["terms"], np.uint64) for r in rows]
        self.numbers = [r["query"] for r in rows]
        self.vocabulary = np.unique(np.concatenate(terms)) if terms else np.empty(0, np.uint64)
        self.places = [np.searchsorted(self.vocabulary, t) for t in terms]
        self.repeats = [np.frombuffer(r["tf"], np.uint32).astype(np.int64) for r in rows]
        self.weights = np.zeros(len(self.vocabulary), np.int64)

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms are in the vocabulary, and where."""
        place = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        own = np.flatnonzero(self.vocabulary[place] == terms)
        return own, place[own]

    def weigh(self, held_by: dict[int, int], documents: int) -> None:
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * held_by.get(t, 0) + 1))) for t in self.vocabulary.view(np.int64).tolist()], np.int64)

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many of a task's documents hold each term of the vocabulary."""
        held = np.zeros(len(self.vocabulary), np.int64)
        for block in blocks(batches):
            held += np.bincount(self.find(block.terms)[1], minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(self.vocabulary[some].view(np.int64)), pa.array(held[some])], ["term", "df"])


class Best:
    """The ``k`` best documents of a query so far: by score, then by id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def threshold(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def _search_block(block: Block, batch: Batch, best: list[Best], documents: int, total: int) -> int:
    """Take the documents of a block into the queries' best ones; returns how many were scored exactly."""
    impacts = block.impacts(documents, total)
    sketches = block.sketches(impacts)
    own, place = batch.find(block.terms)
    first = np.searchsorted(block.doc[own], np.arange(len(block.ids) + 1))
    gain = impacts[own]
    factor = np.zeros(len(batch.vocabulary), np.int64)
    scored = 0
    for places, repeats, top in zip(batch.places, batch.repeats, best):
        weights = repeats * batch.weights[places]
        terms = batch.vocabulary[places]
        most = sketches[0][coordinates(terms, 0)]
        for number in range(1, HASHES):
            np.minimum(most, sketches[number][coordinates(terms, number)], out=most)
        bounds = weights.astype(np.float64) @ most * STEP  # sums of whole numbers below 2 ** 53: no rounding
        candidates = np.flatnonzero(bounds >= top.threshold())
        candidates = candidates[np.argsort(-bounds[candidates], kind="stable")]
        factor[places] = weights
        for at in range(0, len(candidates), RESCORE):
            some = candidates[at:at + RESCORE]
            some = some[bounds[some] >= top.threshold()]  # a bound equal to the threshold may still win by its id
            if not len(some):
                break
            lengths = first[some + 1] - first[some]
            ends = np.cumsum(lengths)
            entry = np.arange(ends[-1]) + np.repeat(first[some] - ends + lengths, lengths)
            sums = np.concatenate([[0], np.cumsum(factor[place[entry]] * gain[entry])])
            scores = sums[ends] - sums[ends - lengths]
            good = scores >= max(top.threshold(), 1)
            top.add(scores[good], block.ids[some][good])
            scored += len(some)
        factor[places] = 0
    return scored


def _queries(items: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per different (id, text) with a term: ``item_id``, a number and its terms."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text"):
            _, first, terms, tf = _postings(texts)
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()) for x in (terms, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(np.diff(first)), *packed], ["item_id", "size", "terms", "tf"])

    chosen = items.select(F.col(id_column).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    found = step(chosen.mapInArrow(rows, "item_id long, size long, terms binary, tf binary").where("size > 0"), "queries")
    placed = with_offsets(found, ["item_id", "terms", "tf"], "size")
    return step(placed.select("item_id", F.col("number").alias("query"), F.expr(f"start div {TERMS_PER_BATCH}").alias("batch"), "terms", "tf"), "numbered")


def search(index: DataFrame, items: DataFrame, k: int = 10, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` best documents of an index for every query with a term: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Only scores above 0 count; equal ones go by ascending id, nulls first. Rows that repeat an id with the same text are one query,
    different texts under one id (nulls included) queries of their own under that id. Queries go in batches of some ``TERMS_PER_BATCH``
    terms, which is what the driver and every task hold; a batch is two passes over the index, which is read where it lies.
    A task folds the impacts of some documents into sketches, looks up the bounds of all of them for each query, and
    scores documents exactly by descending bound until none can reach its ``k`` best. Each task hands on at most ``k`` rows a
    query; the best of them are the result. Nothing is left out: a document not scored has a bound below ``k`` scores.
    """
    spark = index.sparkSession
    documents, total = index.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    queries = _queries(items, id_column, text)
    folder = new_folder(spark, "found")
    numbers = sorted(r[0] for r in queries.select("batch").distinct().collect())
    schema = "query long, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    for number in numbers if documents else []:
        batch = Batch(queries.where(F.col("batch") == number).select("query", "terms", "tf").collect())
        counted = index.select("doc_id", "n", "terms", "tf").mapInArrow(batch.count, "term long, df long").groupBy("term").agg(F.sum("df"))
        batch.weigh(dict(map(tuple, counted.collect())), documents)

        def found(batches: Iterator[pa.RecordBatch], batch: Batch = batch) -> Iterator[pa.RecordBatch]:
            best = [Best(k) for _ in batch.numbers]
            for block in blocks(batches):
                _search_block(block, batch, best, documents, total)
            query = np.repeat(np.array(batch.numbers, np.int64), [len(b.ids) for b in best])
            ids, scores = (np.concatenate([np.empty(0, np.int64), *(getattr(b, c) for b in best)]) for c in ("ids", "scores"))
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], ["query", "doc_id", "score"])

        index.mapInArrow(found, schema).write.mode("append").parquet(folder)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = spark.read.schema(schema).parquet(folder).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return queries.select("query", "item_id").join(ranked, "query").select("item_id", "rank", "doc_id", "score")


def op12_max_sketches(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"unnest(list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> ''))"

ORACLE = f"""
with d as (select row_number() over () as r, doc_id, text from documents),
t as (select r, {_TERMS} as term from d),
tf as (select r, term, count(*) as tf, sum(count(*)) over (partition by r) as n from t group by r, term),
total as (select count(distinct r)::bigint as docs, count(*)::bigint as terms from t),
df as (select term, count(*)::bigint as df from tf group by term),
i as (select row_number() over () as q, item_id, text from (select distinct item_id, text from benchmark)),
qt as (select q, term, count(*)::bigint as qtf from (select q, {_TERMS} as term from i) group by q, term),
weighed as (select q, term, qtf * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w from qt join df using (term), total),
scored as (select q, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - {LENGTH_PCT} + ({LENGTH_PCT} * n::bigint * docs) // terms))))::bigint as score
           from weighed join tf using (term), total group by q, r),
ranked as (select q, doc_id, score, row_number() over (partition by q order by score desc, doc_id nulls first) as rank from scored join d using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked join i using (q) where rank <= 10"""
