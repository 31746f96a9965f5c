"""Sequences of a fixed number of tokens, filled by bounded-space online best-fit."""
from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .chunks import Words, texts_in_chunks

CAPACITY = 2048
OPEN_BINS = 512
BYTES_PER_BLOCK = 4 << 20
KNOWN_WORDS = 2_000_000
WORDS_PER_CALL = 500
TEXTS_PER_CALL = 4
CHUNK_BYTES = 1 << 18

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


#: Words that the tokenizer's normalizer leaves as they are (lower-case, composed), and its parts of such words: fixed by the tokenizer.
PLAIN = re.compile(r"[!-@\[-~ß-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
END_OF_PART = "</w>"


class WordIds:
    """Token ids of texts, by way of the ids of their words.

    The tokenizer puts letters in lower case and splits at white space before it merges, so a text has the ids of
    its words in a row. Words met before are found by their hash in a sorted table of some 25 bytes a word, which is emptied when
    it holds ``KNOWN_WORDS``. A task has its own: nothing of it may be left when the task ends, as a worker runs any number of them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        for tokenizer in (self.tokenizer, self.plain):
            # Its cache of words is not freed with it, some 4 MB a tokenizer; words come here once, so it is of no use.
            resize = getattr(tokenizer.model, "_resize_cache", None)
            if resize:
                resize(0)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(END_OF_PART)]] = True
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.key, self.begin, self.length = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint32)
        self.flat = np.empty(0, self.kind)

    def _encode(self, tokenizer, texts: list[str], per_call: int = WORDS_PER_CALL) -> Iterator[np.ndarray]:
        """What the tokenizer returns takes some 150 bytes a token, so it gets about as many words a call whatever a text holds."""
        for i in range(0, len(texts), per_call):
            yield from (np.array(e.ids, self.kind) for e in tokenizer.encode_batch_fast(texts[i:i + per_call], add_special_tokens=False))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each.

        Plain words go to the tokenizer many at a time, joined by spaces: the ids that end a part are known, and so is the number of parts of
        a word. If they don't add up, as a tokenizer of other parts would have it, and for all other words, each is a text of its own.
        """
        plain = np.fromiter((PLAIN.fullmatch(w) is not None and "<|" not in w for w in words), bool, len(words))
        lengths, found = np.zeros(len(words), np.int64), [None] * 2
        own = [w for w, p in zip(words, plain) if p]
        if own:
            joined = [" ".join(own[i:i + WORDS_PER_CALL]) for i in range(0, len(own), WORDS_PER_CALL)]
            ids = np.concatenate(list(self._encode(self.plain, joined, TEXTS_PER_CALL)))
            parts = np.cumsum(np.fromiter((len(PARTS.findall(w)) for w in own), np.int64, len(own)))
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == parts[-1] and ends[-1] == len(ids) - 1:
                lengths[plain] = np.diff(ends[parts - 1], prepend=-1)
                found[0] = ids
            else:
                plain[:] = False
        rest = [w for w, p in zip(words, plain) if not p]
        coded = list(self._encode(self.tokenizer, rest))
        lengths[~plain] = np.fromiter(map(len, coded), np.int64, len(coded))
        found[1] = np.concatenate([np.empty(0, self.kind), *coded])
        if found[0] is None or not len(rest):
            return (found[1] if found[0] is None else found[0]), lengths
        out = np.empty(int(lengths.sum()), self.kind)
        out[np.repeat(plain, lengths)], out[np.repeat(~plain, lengths)] = found
        return out, lengths

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids, length = self.encode(words)
        begin = len(self.flat) + np.cumsum(length) - length
        self.flat = np.concatenate([self.flat, ids])
        own = np.zeros(len(self.key) + len(keys), bool)
        own[np.searchsorted(self.key, keys) + np.arange(len(keys))] = True
        for name, new in (("begin", begin), ("length", length), ("key", keys)):
            old = getattr(self, name)
            merged = np.empty(len(own), old.dtype)
            merged[own], merged[~own] = new, old
            setattr(self, name, merged)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        words = Words(texts, lower=not any(b"<|" in t for t in texts))  # in lower case, a text could spell a special token
        keys, first, word = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.key) > KNOWN_WORDS:
            self.clear()
        place = np.searchsorted(self.key, keys)
        new = np.flatnonzero(np.append(self.key, np.uint64(0))[place] != keys) if len(self.key) else np.arange(len(keys))
        new = np.union1d(new, np.flatnonzero(place == len(self.key)))
        if len(new):
            spans = zip(words.begin[first[new]].tolist(), words.end[first[new]].tolist())
            self.learn(keys[new], [words.bytes[a:b].decode("utf-8", "replace") for a, b in spans])
            place = np.searchsorted(self.key, keys)
        place = place[word]
        lengths = self.length[place].astype(np.int64)
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.begin[place].astype(np.int64) - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        sums = np.concatenate([[0], ends])
        return ids, sums[words.first[1:]] - sums[words.first[:-1]]


class OpenBins:
    """At most ``limit`` open bins; bit f of ``free`` is set while one has f tokens free."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.count, self.made, self.free = capacity, limit, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        own = self.bins[space]
        number = own.pop()
        if not own:
            self.free ^= 1 << space
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset for a piece: the open bin with the least space that is enough, else a new one.
        Past the limit the fullest open bin is closed."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            if self.count == self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            self.bins[left].append(number)
            self.free |= 1 << left
            self.count += 1
        return number, self.capacity - space


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, open_bins: int = OPEN_BINS,
                   id_column: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenize documents, close each with ``end_id``, cut only those longer than ``capacity`` and pack the pieces.

    One row per piece: ``doc_id``, ``piece``, ``start`` (ids of the document before it), ``length``, ``ids_crc32``
    (of its ids as little-endian unsigned 32-bit numbers), ``sequence_id``, ``offset`` in the sequence, and with
    ``with_ids`` the ``ids``. Each task packs the documents it reads, one after the other, into bins of its own; at
    most ``open_bins`` are open, so a task needs the same memory however many documents come. Nothing is shuffled. Parts with
    texts of less than some 4 MB are read together, as each part leaves a few bins part filled.
    An empty or null text is the one id ``end_id``. Repeated rows are packed as often as they come; null ids stay null. Bytes that are no UTF-8 are
    read as replacement characters. Other columns are not read.
    """
    parts = docs.rdd.getNumPartitions()
    blocks = max(1, (docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0) // BYTES_PER_BLOCK)
    columns = SCHEMA + (", ids array<int>" if with_ids else "")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(tokenizer_path)
        bins, prefix = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 32
        for batch, texts in texts_in_chunks(batches, text, CHUNK_BYTES):
            ids, counts = ids_of(texts)
            rows: list[tuple] = []
            own_ids: list[np.ndarray] = []
            at = 0
            for doc, count in zip(batch.column(0).to_pylist(), counts.tolist()):
                own = np.append(ids[at:at + count], np.uint32(end_id)).astype("<u4")
                at += count
                for piece, start in enumerate(range(0, count + 1, capacity)):
                    part = own[start:start + capacity]
                    number, offset = bins.place(len(part))
                    rows.append((doc, piece, start, len(part), zlib.crc32(part), prefix | number, offset))
                    if with_ids:
                        own_ids.append(part)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in own_ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias(text))
    return chosen.coalesce(min(parts, blocks) or 1).mapInArrow(packed, columns)


def op10_best_fit(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens of a public tokenizer."""
    from public_tokenizers import path

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), path("word_bpe_49k.json"))
