"""Texts of a task in bounded chunks, as arrays of word hashes."""
from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

CHUNK_BYTES = 2 << 20
NO_ID = -(1 << 62)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def document_key(id_column: str, text: str) -> Column:
    """The id; for a null id a number below all ids (which are taken to be above ``NO_ID``) that depends on the text."""
    own = F.col(id_column).cast("long")
    return F.coalesce(own, F.lit(NO_ID) - F.lit(1) - F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 61)))


def document_id(key: str) -> Column:
    return F.when(F.col(key) > NO_ID, F.col(key))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if n <= 2 * CHUNK_BYTES:
            _powers[base] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values, by differences of one running polynomial sum."""
    n = len(values)
    if n < k:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BASE, n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * powers(INVERSE, n - k + 1))


def give_back() -> None:
    """Return what is free to the system: workers live on from step to step, and what the next one needs must be free."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def texts_in_chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts have at most ``limit`` bytes (a longer text is a slice of its own), with
    the texts as bytes, nulls as empty ones. Only the texts of one slice are copied at a time. What the worker's last task left behind is given back first."""
    give_back()
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        begin, held = 0, 0
        for i, length in enumerate([*lengths, None]):
            if i > begin and (length is None or held + length > limit):
                yield batch.slice(begin, i - begin), [t or b"" for t in column.slice(begin, i - begin).to_pylist()]
                begin, held = i, 0
            held += length or 0
        del column, batch
        give_back()


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts: byte places, the text each belongs to, and 64-bit hashes.

    Two words share a hash with odds of about 2 ** -64; all exact results here rest on that.
    """

    _space = np.zeros(256, bool)
    _space[[32, 9, 10, 11, 12, 13]] = True
    _codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def __init__(self, texts: list[bytes], lower: bool):
        joined = b" ".join([b"", *texts, b""])
        self.bytes = joined.lower() if lower else joined
        buffer = np.frombuffer(self.bytes, np.uint8)
        space = self._space[buffer]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.begin, self.end = edges[0::2], edges[1::2]
        codes = self._codes[buffer]
        codes[space] = 0
        codes *= powers(BASE, len(buffer))
        sums = np.cumsum(codes, out=codes)
        self.hash = mix((sums[self.end - 1] - sums[self.begin - 1]) * powers(INVERSE, len(buffer))[self.begin])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        text_ends = np.cumsum(lengths + 1)
        #: words of text i: first[i] to first[i + 1]
        self.first = np.concatenate([[0], np.searchsorted(self.begin, text_ends)])
        self.count = np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each run of ``k`` words that lies in one text."""
        hashes = rolling(self.hash, k)
        if not len(hashes):
            return hashes, np.empty(0, np.int64)
        text = self.text_of()
        inside = np.flatnonzero(text[: len(hashes)] == text[k - 1:])
        return hashes[inside], inside
