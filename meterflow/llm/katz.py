"""Language-model scores: Katz backoff from runs of three tokens to pairs, words and the unknown word, with Good-Turing discounts."""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .chunks import Words, document_id, document_key, give_back, mix, texts_in_chunks
from .store import step
from .toxicity import held_out

ORDER = 3
BLOCK_BYTES = 6 << 20
PART_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
#: A block is a row of a few MB: rows are written in small groups, so that a reader holds few of them.
ROW_GROUPS = {"parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}
#: Lengths of run, less one, that are counted at a time: what lies on disk between blocks and parts is the hashes of these.
COUNTED = ((2,), (0, 1))
#: Of the texts of stored blocks.
LEVEL = 6
#: Counts up to this have discounts of their own.
LARGEST = 5
END = np.uint64(0xA0761D6478BD642F)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the lower-cased texts, each text closed by ``END``, and the number of each text's tokens."""
    words = Words(texts, lower=True)
    return np.insert(words.hash, words.first[1:], END), words.count + 1


def runs(tokens: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 .. ``order`` tokens that lie in one text: the place of the last token of each, and its hash."""
    into = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
    key = mix(tokens ^ np.uint64(0x8EBC6AF09C88C6E3))
    for n in range(order):
        place = np.flatnonzero(into >= n)
        if n:
            key[place] = mix(before[place - 1] * np.uint64(0xE7037ED1A0B428DB) + tokens[place] + np.uint64(n))
        yield place, key[place]
        before = key.copy()


@dataclass
class Discounts:
    """What is left of a count: the Good-Turing share for small ones; larger ones lose as much as ``LARGEST`` does, so that
    every context has something to give to what was not seen after it."""
    small: np.ndarray

    @classmethod
    def fit(cls, having: list[int]) -> Discounts:
        """From the numbers of n-grams that occur 1, 2 .. ``LARGEST`` + 1 times. Where they are too few for Good-Turing shares
        that rise and lie between 0 and 1, the share is that of one absolute discount."""
        n = np.array([0, *having], float)
        r = np.arange(1, LARGEST + 1)
        if (n[1:] > 0).all():
            top = (LARGEST + 1) * n[LARGEST + 1] / n[1]
            shares = ((r + 1) * n[r + 1] / (n[r] * r) - top) / (1 - top) if top < 1 else np.zeros(LARGEST)
            if (shares > 0).all() and (shares < 1).all() and (np.diff(shares * r) > 0).all():
                return cls(shares)
        lost = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return cls(1 - lost / r)

    def __call__(self, count: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        count = np.asarray(count, float)
        lost = LARGEST * (1 - self.small[-1])
        small = np.concatenate([[0.0], self.small])[np.minimum(count, LARGEST).astype(np.int64)] * count
        return np.where(count <= LARGEST, small, count - lost)


@dataclass
class Totals:
    """Sums over the training tokens: ``tokens``, ``words`` (different ones), the discounts by length of run, and the probability of
    the unknown word."""
    tokens: int
    words: int
    discounts: list[Discounts]
    unknown: float

    @classmethod
    def fit(cls, tokens: int, words: int, having: list[list[int]]) -> Totals:
        discounts = [Discounts.fit(h) for h in having]
        small, r, word = np.array(having[0][:LARGEST], float), np.arange(1, LARGEST + 1), discounts[0]
        lost = ((1 - word.small) * r * small).sum() + LARGEST * (1 - word.small[-1]) * (words - small.sum())
        return cls(tokens, words, discounts, lost / tokens if tokens else 1.0)


@dataclass
class Block:
    """The different documents of a block: tokens, tokens per document, and how many of a document's rows are learnt from."""
    number: int
    names: np.ndarray
    docs: np.ndarray
    tokens: np.ndarray
    counts: np.ndarray
    learnt: np.ndarray

    def types(self, lengths: Iterable[int] = range(ORDER)) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By length of run, less one: the length, places of last tokens, the different hashes in order, the place of the first of each, and which each run is."""
        for k, (place, key) in enumerate(runs(self.tokens, self.counts)):
            if k in lengths:
                yield k, place, *np.unique(key, return_index=True, return_inverse=True)


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte: first the lowest bytes of all, then the next ones. Upper bytes are mostly alike."""
    width = numbers.itemsize
    planes = np.ascontiguousarray(np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(numbers).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if len(numbers) else b"")


def _restored(squeezed: bytes, kind: str = "u") -> np.ndarray:
    """The numbers, of ``kind`` (u: unsigned, i: signed, f: floating) and the width they had."""
    width, size = squeezed[0], int.from_bytes(squeezed[1:9], "little")
    if not size:
        return np.empty(0, f"{kind}{width}")
    planes = np.frombuffer(pa.decompress(memoryview(squeezed)[9:], size * width, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(f"{kind}{width}").ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers, as their differences."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(_restored(packed), dtype=np.uint64)


def _parts(keys: np.ndarray, bits: int) -> tuple[list[int], list[slice]]:
    """The parts that ascending hashes fall into, by their upper ``bits``, and where the hashes of each stand."""
    edges = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.uint64)
    cut = np.append(np.searchsorted(keys, edges), len(keys))
    parts = np.flatnonzero(np.diff(cut))
    return parts.tolist(), [slice(a, b) for a, b in zip(cut[parts].tolist(), cut[parts + 1].tolist())]


def _batch(schema: str, size: int, /, **columns) -> pa.RecordBatch:
    """A batch of ``size`` rows with these columns, the others null."""
    kinds = {"long": pa.int64(), "binary": pa.binary(), "tinyint": pa.int8(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[k]) if c in columns else pa.nulls(size, kinds[k]) for c, k in fields], [c for c, _ in fields])


_BLOCKS = "block long, size long, docs binary, text binary"


class _Gathered:
    """A block that grows by documents. Rows that repeat a document are counted, not held."""

    def __init__(self):
        self.place: dict[int, int] = {}
        self.names, self.learnt, self.texts, self.bytes = [], [], [], 0

    def add(self, name: int, doc: int, train: bool, text: bytes) -> None:
        if doc in self.place:
            self.learnt[self.place[doc]] += train
            return
        self.place[doc] = len(self.names)
        self.names.append(name)
        self.learnt.append(int(train))
        self.texts.append(text)
        self.bytes += len(text) + 8

    def row(self, number: int) -> pa.RecordBatch:
        docs = np.array([self.names, list(self.place), self.learnt, [len(t) for t in self.texts]], np.int64)
        text = pa.Codec("zstd", compression_level=LEVEL).compress(b"".join(self.texts), asbytes=True)
        return _batch(_BLOCKS, 1, block=[number], size=[self.bytes], docs=[_squeezed(docs.ravel())], text=[text])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a task, rows (named, doc, train, text), as blocks of some ``BLOCK_BYTES``, with numbers of their own."""
    task, made, now = TaskContext.get().partitionId(), 0, _Gathered()
    for batch, texts in texts_in_chunks(batches, "text", min(CHUNK_BYTES, BLOCK_BYTES)):
        for row in zip(*(batch.column(c).to_pylist() for c in ("named", "doc", "train")), texts):
            now.add(*row)
        if now.bytes >= BLOCK_BYTES:
            yield now.row(task << 32 | made)
            made, now = made + 1, _Gathered()
    if now.place:
        yield now.row(task << 32 | made)


def _block(number: int, docs: bytes, text: bytes) -> Block:
    """A block from its row. Only a chunk of its texts at a time is held beside the tokens."""
    names, ids, learnt, lengths = _restored(docs, "i").reshape(4, -1)
    ends = np.cumsum(lengths).tolist()
    joined = memoryview(pa.decompress(text, ends[-1], "zstd")) if ends[-1] else memoryview(b"")
    parts, texts, held, begin = [], [], 0, 0
    for end in ends:
        if texts and held + end - begin > CHUNK_BYTES:
            parts.append(tokens_of(texts))
            texts, held = [], 0
        texts.append(bytes(joined[begin:end]))
        held, begin = held + end - begin, end
    parts.append(tokens_of(texts))
    del joined, texts
    tokens, counts = (np.concatenate(x) for x in zip(*parts))
    return Block(number, names, ids, tokens, counts, learnt)


_SENT = "part long, block long, keys binary, n binary"


def _counts(bits: int, lengths: tuple[int, ...]):
    """A function from blocks to rows (part, block, packed hashes, numbers): every hash of a block's runs of these lengths once, with its count in what is
    learnt from, doubled, and 1 more if a document that is not learnt from has it. A part has the runs of one length whose hashes share
    their upper ``bits``; only parts that a block has runs in get a row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _block(*(batch.column(c)[i].as_py() for c in ("block", "docs", "text")))
                weight = np.repeat(block.learnt, block.counts)
                for k, place, key, _, which in block.types(lengths):
                    n = np.bincount(which, weight[place], len(key)).astype(np.uint32) * np.uint32(2)
                    n[which[weight[place] == 0]] |= np.uint32(1)
                    parts, cut = _parts(key, bits)
                    yield _batch(_SENT, len(parts), part=[p * ORDER + k for p in parts], block=[block.number] * len(parts),
                                 keys=[_packed(key[c]) for c in cut], n=[_squeezed(n[c]) for c in cut])
                del block
                give_back()
    return rows


def _by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one part after the other, from rows in the order of parts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist() if len(part) else []
        for begin, end in zip(starts, [*starts[1:], len(part)]):
            if held and held[-1].column("part")[0].as_py() != part[begin]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


_ANSWERED = "part long, block long, reply binary, sums array<long>"


def _totalled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block asked for: four times the counts over all blocks, in the order it sent its hashes, 2 more if a document that is not
    learnt from has the run, and 1 more in the one block that speaks for it. One row of each part has its sums: tokens, different runs, and how many of them occur 1, 2 .. times."""
    for table in _by_part(batches):
        keys = [_unpacked(x) for x in table["keys"].to_pylist()]
        n = np.concatenate([_restored(x) for x in table["n"].to_pylist()])
        ends = np.cumsum([len(x) for x in keys]).tolist()
        known, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        del keys
        total = np.bincount(which, n >> np.uint32(1), len(known)).astype(np.int64)
        wanted = np.bincount(which, n & np.uint32(1), len(known)) > 0
        having = np.bincount(np.minimum(total, LARGEST + 2), minlength=LARGEST + 3)[1:LARGEST + 2]
        answer = (total * 4 + wanted * 2)[which]
        answer[first] += 1
        replies = [_squeezed(answer[a:b].astype(np.uint64 if answer.max() >> 32 else np.uint32)) for a, b in zip([0, *ends], ends)]
        sums = [[int(total.sum()), int((total > 0).sum()), *having.tolist()], *[None] * (len(ends) - 1)]
        yield _batch(_ANSWERED, len(ends), part=table["part"].to_pylist(), block=table["block"].to_pylist(), reply=replies, sums=sums)
        del table, n, known, first, which, total, wanted, answer, replies
        give_back()


_SCORES = "part long, kind tinyint, block long, keys binary, x binary, y binary, z binary"


def _scored(totals: Totals, bits: int):
    """A function from blocks, each after the replies to it, to rows of packed numbers: (0: documents; their name, tokens, known ones;
    base and model score so far), (n: contexts of n tokens; their counts, what the runs they begin take of it, what they have without
    their first token) for the runs that the block speaks for and that follow a context some document may back off from, and (-n: contexts of n tokens; the
    place in the block of a document that backs off from it, how often). Contexts are dealt to parts as runs are, documents to parts below 0."""
    def score(block: Block, replies: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size, n_docs = len(block.tokens), len(block.docs)
        count = [np.zeros(size, np.int64) for _ in range(ORDER)]       # of the run of n + 1 tokens that ends at each place
        key = [np.zeros(size, np.uint64) for _ in range(ORDER - 1)]
        chance = [np.zeros(size) for _ in range(ORDER)]                # of its last token, where it was seen
        wanted = [np.zeros(size, bool) for _ in range(ORDER - 1)]      # as a context: some document may back off from it
        for k, place, known, first, which in block.types():
            answer, replies[k] = replies[k].astype(np.int64), None
            count[k][place] = (answer >> 2)[which]
            if k < ORDER - 1:
                key[k][place], wanted[k][place] = known[which], (answer & 2 > 0)[which]
            speaks = place[first[(answer & 1 > 0) & (answer >= 4)]]
            del answer, known, first, which
            before = np.full(size, totals.tokens) if not k else np.concatenate([[0], count[k - 1][:-1]])
            seen = place[count[k][place] > 0]
            chance[k][seen] = totals.discounts[k](count[k][seen]) / before[seen]
            del before, seen, place
            if not k:
                chance[0][count[0] == 0] = totals.unknown
                continue
            at = speaks[wanted[k - 1][speaks - 1]]
            context, which = np.unique(key[k - 1][at - 1], return_inverse=True)
            held = np.zeros(len(context), np.int64)
            held[which] = count[k - 1][at - 1]
            yield sent(block, k, k, context, held, np.bincount(which, totals.discounts[k](count[k][at]), len(context)), np.bincount(which, chance[k - 1][at], len(context)))
            del speaks, at, context, which, held
        open_, found = np.ones(size, bool), np.zeros(size)
        into = np.arange(size) - np.repeat(np.cumsum(block.counts) - block.counts, block.counts)
        doc = np.repeat(np.arange(n_docs, dtype=np.uint64), block.counts)
        for k in range(ORDER - 1, -1, -1):  # the longest run that was seen; on the way down, the contexts that were
            seen = open_ & ((count[k] > 0) | (k == 0)) & (into >= k)
            found[seen] = np.log10(chance[k][seen])
            open_ &= ~seen
            if k:
                off = np.flatnonzero(open_ & (into >= k))
                off = off[count[k - 1][off - 1] > 0]
                off = off[np.lexsort((doc[off], key[k - 1][off - 1]))]
                context, owner = key[k - 1][off - 1], doc[off]
                new = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (owner[1:] != owner[:-1])])[:len(off)])
                yield sent(block, k, -k, context[new], owner[new], np.diff(new, append=len(off)))
        doc = doc.astype(np.int64)
        base = np.log10((count[0] + 1) / (totals.tokens + totals.words + 1))
        about = np.concatenate([block.names, block.docs, block.counts, np.bincount(doc, count[0] > 0, n_docs).astype(np.int64)])
        yield _batch(_SCORES, 1, part=[-1 - block.number % 1024], kind=[0], block=[block.number], x=[_squeezed(about)],
                     y=[_squeezed(np.bincount(doc, base, n_docs))], z=[_squeezed(np.bincount(doc, found, n_docs))])

    def sent(block: Block, k: int, kind: int, context: np.ndarray, *numbers: np.ndarray) -> pa.RecordBatch:
        parts, cut = _parts(context, bits)
        columns = {c: [_squeezed(n[own]) for own in cut] for c, n in zip("xyz", numbers)}
        return _batch(_SCORES, len(parts), part=[p * ORDER + k for p in parts], kind=[kind] * len(parts), block=[block.number] * len(parts),
                      keys=[_packed(context[own]) for own in cut], **columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = [[] for _ in range(ORDER)]
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                if part is not None:
                    waiting[part % ORDER].append(_restored(batch.column("reply")[i].as_py()))
                    continue
                own = [np.concatenate([np.empty(0, np.uint32), *x]) for x in waiting]
                waiting = [[] for _ in range(ORDER)]
                yield from score(_block(*(batch.column(c)[i].as_py() for c in ("block", "docs", "text"))), own)
                del own
                give_back()

    return rows


_EACH = "block long, at long, id long, name long, n_tokens long, n_known long, base_score double, found double, more double"


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the rows of ``_scored``, by part and the contexts' own before those of documents: rows of documents (block, place in it, what is known),
    and of what their backing off from the contexts of a part adds (block, place in it, more)."""
    for table in _by_part(batches):
        own: list[tuple] = []
        weight = known = None
        for row in (r for b in table.to_batches(1024) for r in b.to_pylist()):
            if row["kind"] == 0:
                names, ids, n_tokens, n_known = _restored(row["x"], "i").reshape(4, -1)
                yield _batch(_EACH, len(ids), block=np.full(len(ids), row["block"]), at=np.arange(len(ids)), id=ids, name=names, n_tokens=n_tokens, n_known=n_known,
                             base_score=_restored(row["y"], "f"), found=_restored(row["z"], "f"))
                continue
            keys = _unpacked(row["keys"])
            if row["kind"] > 0:
                own.append((keys, _restored(row["x"], "i"), _restored(row["y"], "f"), _restored(row["z"], "f")))
                continue
            if known is None:
                every, count, taken, lower = (np.concatenate(x) for x in zip(*own)) if own else (np.empty(0, t) for t in (np.uint64, np.int64, float, float))
                own = []
                known, first, which = np.unique(every, return_index=True, return_inverse=True)
                weight = np.log10((1 - np.bincount(which, taken, len(known)) / count[first]) / (1 - np.bincount(which, lower, len(known))))
                del every, count, taken, lower, first, which
            place = np.searchsorted(known, keys)
            hit = np.flatnonzero(np.append(known, np.uint64(0))[place] == keys) if len(known) else np.empty(0, np.int64)
            hit = hit[place[hit] < len(known)]
            docs, which = np.unique(_restored(row["x"], "i")[hit], return_inverse=True)
            yield _batch(_EACH, len(docs), block=np.full(len(docs), row["block"]), at=docs, more=np.bincount(which, _restored(row["y"], "i")[hit] * weight[place[hit]], len(docs)))
        del table, own, weight, known
        give_back()


def score_documents(docs: DataFrame, learn, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every text under a model learnt from the rows where ``learn`` (a column; null: no) holds.

    A document's tokens are its lower-cased words and one end. A run of three tokens that was seen has its discounted count over that
    of the first two; others have the probability of their last two, found in the same way, times the weight that makes all that may follow the
    first two sum to 1; so on down to single words, and words not seen share one unknown word. What a task reads is cut into blocks of some
    ``BLOCK_BYTES``, which are written once, compressed. A block sends the hash of each of its runs once with its count, packed, dealt to parts of the
    table of counts, runs of three tokens first and the shorter ones after them; a part adds them up and answers every block with the counts in the order it asked. The answers and the blocks meet by
    block, streamed in sorted order; contexts and those who back off from them meet by part, packed as the counts are. Per document: ``doc_id``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one) and
    ``score``, both log10. Null and empty texts have the end alone. Rows that repeat an id count as often as they come in what is learnt, and
    give one row if their texts agree; so do rows of one text without an id. Two texts under one id are two documents.
    """
    every = docs.select(document_key(id_column, text).alias("named"), F.coalesce(learn, F.lit(False)).alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = every.withColumn("doc", F.xxhash64("named", "text")).select("named", "doc", "train", "text")
    blocks = step(every.mapInArrow(_cut, _BLOCKS), "blocks", **ROW_GROUPS)
    bits = ((blocks.agg(F.sum("size")).first()[0] or 0) // PART_BYTES).bit_length()
    sent = [blocks.select("block", "docs", "text").mapInArrow(_counts(bits, lengths), _SENT) for lengths in COUNTED]
    answered = [step(s.repartition("part").sortWithinPartitions("part", "block").mapInArrow(_totalled, _ANSWERED), "replies") for s in sent]
    replies = reduce(DataFrame.unionAll, answered)
    sums = replies.where("sums is not null").select((F.col("part") % ORDER).alias("k"), F.posexplode("sums").alias("at", "n")).groupBy("k", "at").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros((ORDER, 3 + LARGEST), np.int64)
    for r in sums:
        seen[r["k"], r["at"]] = r["n"]
    totals = Totals.fit(int(seen[0, 0]), int(seen[0, 1]), seen[:, 2:].tolist())

    left = replies.select("block", "part", "reply", *[F.lit(None).cast("binary").alias(c) for c in ("docs", "text")])
    right = blocks.select("block", F.lit(None).cast("long").alias("part"), F.lit(None).cast("binary").alias("reply"), "docs", "text")
    mixed = left.unionAll(right).repartition("block").sortWithinPartitions("block", F.col("part").asc_nulls_last())
    scored = mixed.mapInArrow(_scored(totals, bits), _SCORES).repartition("part").sortWithinPartitions("part", F.col("kind").desc(), "block")
    parts = step(scored.mapInArrow(_weighted, _EACH), "scores")
    # A document has one row for each block that it was read in, all with the same scores.
    each = parts.groupBy("block", "at").agg(*[F.max(c).alias(c) for c in ("id", "name", "n_tokens", "n_known", "base_score", "found")], F.sum("more").alias("more"))
    return each.dropDuplicates(["id"]).select(
        document_id("name").alias("doc_id"), "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"),
        "base_score", (F.col("found") + F.coalesce("more", F.lit(0.0))).alias("score"))


def op7_katz(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model learnt from six sevenths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out("doc_id", 7, 2)
    return score_documents(docs, ~out).select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
