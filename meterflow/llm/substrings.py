"""Repeated runs of words: hashes at the positions of a difference cover, extended to whole windows."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chunks import Words, document_id, document_key, mix, texts_in_chunks
from .store import step

WINDOW = 20
PERIOD = 13
#: Every difference modulo 13 is one of two of these.
COVER = (0, 1, 3, 9)


def covers_all(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _table(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names.split())


def _rows(key: np.ndarray, doc: np.ndarray, place: np.ndarray, others: bool) -> pa.RecordBatch:
    """One row for each key of a chunk, its first occurrence, to be compared with other chunks. The further ones are known to be
    repeated (``sure``) and go under keys of their own, so a key has as many rows as there are chunks at most.
    With ``others`` the first is sure as well if its key has several rows. A place that comes twice counts once."""
    order = np.lexsort((place, doc, key))
    key, doc, place = key[order], doc[order], place[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
    key, doc, place = key[new], doc[new], place[new]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    several = ~first | ~np.append(first[1:], True)
    spread = mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    return _table("key doc place sure", np.where(first, key, spread).view(np.int64), doc, place.astype(np.int32), ~first | (several & others))


KEYED = "key long, doc long, place int, sure boolean"


def _repeated(keyed: DataFrame, later_only: bool) -> DataFrame:
    """(``doc``, ``place``) of rows that are sure or share their key with another row (``later_only``: with an earlier one)."""
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "doc", "place"] if later_only else ["key"]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, which the next batch may share its key with
        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, place, sure = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if held is not None:
                key, doc, place, sure = (np.concatenate([[h], c]) for h, c in zip(held, (key, doc, place, sure)))
            same = key[1:] == key[:-1]
            if later_only:
                again = np.concatenate([[False], same & ((doc[1:] != doc[:-1]) | (place[1:] != place[:-1]))])
                chain = np.flatnonzero(np.concatenate([[True], ~same]))  # what follows a later one of its key is later too
                group = np.repeat(np.arange(len(chain)), np.diff(np.append(chain, len(key))))
                seen = np.cumsum(again)
                again = seen > (seen[chain] - again[chain])[group]
                again |= (group == 0) & bool(held is not None and held_again)
            else:
                again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
                again[0] |= bool(held is not None and held_again)
            found = sure.astype(bool) | again
            held, held_again = (key[-1], doc[-1], place[-1], sure[-1]), again[-1]
            out = found[:-1]
            yield _table("doc place", doc[:-1][out], place[:-1][out].astype(np.int32))
        if held is not None and (held[3] or held_again):
            yield _table("doc place", np.array([held[1]]), np.array([held[2]], np.int32))

    return keyed.repartition(parts, "key").sortWithinPartitions(*order).mapInArrow(kept, "doc long, place int")


def _places(words: Words) -> tuple[np.ndarray, np.ndarray]:
    text = words.text_of()
    return text, np.arange(len(text)) - words.first[text]


def _anchors(docs: DataFrame, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    length = window - period + 1
    aligned = np.zeros(period, bool)
    aligned[list(cover)] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text"):
            words = Words(texts, lower=False)
            hashes, first = words.windows(length)
            text, place = _places(words)
            own = first[aligned[place[first] % period] & (words.count[text[first]] >= window)]
            if len(own):
                yield _rows(hashes[np.searchsorted(first, own)], batch.column("doc").to_numpy()[text[own]], place[own], others=True)

    return docs.select("doc", "text").mapInArrow(rows, KEYED)


def _windows(docs: DataFrame, window: int, period: int) -> DataFrame:
    """Windows that hold one of the document's repeated anchors within ``period`` words of their start."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text"):
            words = Words(texts, lower=False)
            hashes, first = words.windows(window)
            if not len(first):
                continue
            text, place = _places(words)
            lists = batch.column("places")
            owner, at = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            anchor = (words.first[owner] + at)[at < words.count[owner]]  # of two texts under one id, one may be shorter
            marks = np.zeros(len(text) + 1, np.int32)
            np.add.at(marks, np.maximum(anchor - period + 1, words.first[text[anchor]]), 1)
            np.add.at(marks, anchor + 1, -1)
            asked = np.cumsum(marks)[first] > 0
            own = first[asked]
            if len(own):
                yield _rows(hashes[asked], batch.column("doc").to_numpy()[text[own]], place[own], others=False)

    return docs.select("doc", "text", "places").mapInArrow(rows, KEYED)


def _kept(docs: DataFrame, window: int, with_text: bool) -> DataFrame:
    schema = "doc long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text"):
            total, removed, digest, kept = [], [], [], []
            for t, starts in zip(texts, batch.column("places")):
                own = t.split()
                total.append(len(own))
                if starts.is_valid:
                    marks = np.zeros(len(own) + 1, np.int32)
                    begin = np.minimum(starts.values.to_numpy(), len(own))
                    np.add.at(marks, begin, 1)
                    np.add.at(marks, np.minimum(begin + window, len(own)), -1)
                    own = [own[i] for i in np.flatnonzero(np.cumsum(marks)[:-1] == 0).tolist()]
                removed.append(total[-1] - len(own))
                left = b" ".join(own)
                digest.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left.decode("utf-8", "replace"))
            names = "doc n_words n_removed kept_sha256" + " kept" * with_text
            yield _table(names, batch.column("doc"), np.array(total, np.int64), np.array(removed, np.int64), digest, *[kept] * with_text)

    return docs.select("doc", "text", "places").mapInArrow(rows, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text: str = "text", with_text: bool = False,
                   period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """Remove every word that lies in a run of ``window`` words which also starts earlier (a smaller id, or further up).

    Of any two places some shift below ``period`` moves both onto positions of the cover, so two equal windows share
    a hash of ``window`` - ``period`` + 1 words at such a position. Hashes found once are dropped; only windows around the
    others are hashed whole and compared, exactly but for 64-bit hashes. Per row: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256`` and with ``with_text`` the ``kept`` words. A null text has no words; null ids
    come before all others; rows that repeat an id (or have none) and a text are one document and give that row as often as they come.
    """
    if not covers_all(period, cover) or period > window:
        raise ValueError("the cover must hold every difference, and the period fit into the window")
    own = docs.select(document_key(id_column, text).alias("doc"), F.col(text).alias("text"))
    anchors = step(_repeated(_anchors(own, window, period, cover), later_only=False), "anchors")
    of_doc = anchors.groupBy("doc").agg(F.collect_list("place").alias("places"))
    removed = step(_repeated(_windows(own.join(of_doc, "doc"), window, period), later_only=True), "removed")
    starts = removed.groupBy("doc").agg(F.collect_list("place").alias("places"))
    found = _kept(own.join(starts, "doc", "left"), window, with_text)
    return found.select(document_id("doc").alias("doc_id"), *found.columns[1:])


def op5_difference_cover(spark, sf_dir: str) -> DataFrame:
    """Runs of 20 words that appeared before, removed from every document."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
windows as (select doc_id, i, array_to_string(w[i + 1:i + {WINDOW}], ' ') as s from (select *, unnest(range(len(w) - {WINDOW - 1})) as i from d)),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as n from windows) where n > 1),
covered as (select distinct doc_id, unnest(range(i, i + {WINDOW})) as p from later),
words as (select doc_id, p, w[p + 1] as word from (select *, unnest(range(len(w))) as p from d)),
kept as (select doc_id, string_agg(word, ' ' order by p) as s, count(*) as n from words anti join covered using (doc_id, p) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(s, '')) as kept_sha256
from d left join kept using (doc_id)"""
