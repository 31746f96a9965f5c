"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.storage import settled
from .chunks import give_back, mix, texts_in_chunks
from .store import small_batches

ORDERS = (4, 5, 6, 7)
BITS = 20
SLICES = 64
ROWS_PER_CLASS = 6_000
PARTS = 16
CHUNK_BYTES = 1 << 17
SMOOTHING = 4.0
MIN_SURPRISE = 10.0
PER = 1000.0
AT_ONCE = 1 << 20
ROWS_AT_ONCE = 256
SENT_AT_ONCE = 1 << 16


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature number of each byte n-gram of the lower-cased texts, the text it is of, and n-grams per text.

    A text is read with one space before and after it; white space counts as a space. The feature is a hash of ``BITS`` bits.
    """
    joined = b"".join(b" " + t.lower() + b" " for t in texts)
    buffer = np.frombuffer(joined, np.uint8)
    codes = np.where((buffer >= 9) & (buffer <= 13), 32, buffer).astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    features, owners, state = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        state = state[:size] * np.uint64(257) + codes[n - 1:]
        if n in ORDERS:
            inside = text[:size] == text[n - 1:]
            features.append((mix(state[inside] * np.uint64(16) + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32))
            owners.append(text[:size][inside])
    if not features:
        return np.empty(0, np.int32), np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    owner = np.concatenate(owners)
    return np.concatenate(features), owner, np.bincount(owner, minlength=len(texts))


def counted(feature: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, feature) with their counts."""
    keys, counts = np.unique(owner.astype(np.int64) << BITS | feature, return_counts=True)
    return keys >> BITS, keys & ((1 << BITS) - 1), counts


@dataclass
class Model:
    """Coefficients of the kept features (ratio times weight), and the intercept."""
    features: np.ndarray
    coefficients: np.ndarray
    intercept: float


def _scores(table: np.ndarray, kept: np.ndarray, intercept: float, texts: list[bytes]) -> np.ndarray:
    feature, owner, total = ngrams(texts)
    own = kept[feature]
    text, feature, count = counted(feature[own], owner[own])
    sums = np.bincount(text, np.log1p(count / total[text] * PER) * table[feature], len(texts)) + intercept
    return 1 / (1 + np.exp(-np.clip(sums, -60, 60)))


def _sample(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, per_class: int) -> DataFrame:
    """Text and label of at most ``per_class`` labelled documents of each class, those with the least hash of the id.

    The ids picked are at most twice ``per_class``: they are sent to every task, and only their texts are moved.
    """
    clean = (labels.where(F.col(id_column).isNotNull() & F.col(label).isin(0, 1)).groupBy(id_column).agg(F.max(label).alias("_label")))
    by_hash = [F.xxhash64(F.col(id_column)), F.col(id_column)]
    picked = [clean.where(F.col("_label") == k).orderBy(*by_hash).limit(per_class) for k in (0, 1)]
    few = settled(picked[0].union(picked[1]), "picked")
    return docs.select(id_column, text).join(F.broadcast(few), id_column).select(F.col(text).alias("text"), "_label").repartition(PARTS)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (text, _label): the features, and the numbers of rows of either class that have each."""
    found = np.zeros(2 << BITS, np.int32)  # a part has fewer documents than that holds
    for batch, texts in texts_in_chunks(batches, "text", CHUNK_BYTES):
        classes = np.array(batch.column("_label").to_pylist())
        owner, feature, _ = counted(*ngrams(texts)[:2])
        np.add.at(found, classes[owner] << BITS | feature, np.int32(1))
    found = found.reshape(2, -1)
    feature = np.flatnonzero(found.any(axis=0))
    for at in (feature[i:i + SENT_AT_ONCE] for i in range(0, len(feature), SENT_AT_ONCE)):
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(found[k][at].astype(np.int64)) for k in (0, 1))], ["feature", "clean", "toxic"])


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = ROWS_PER_CLASS, rounds: int = 80) -> Model:
    """Fit on a bounded sample: at most ``per_class`` labelled documents of each class, classes weighted as in the labels.

    Document frequencies of every n-gram by class are counted in Spark. The log-count ratio of a feature is
    smoothed towards none by ``SMOOTHING`` expected documents; features whose frequencies differ by a
    log-likelihood ratio under ``MIN_SURPRISE`` are left out. The weights are fitted on the counts of the kept
    features in the sample, by logistic regression in one task. Without labels of both classes the model knows no
    feature, and its intercept is the share of the class there is.
    """
    with small_batches(docs.sparkSession):
        return _trained(docs, labels, id_column, text, label, per_class, rounds)


def _trained(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, per_class: int, rounds: int) -> Model:
    share = {r["k"]: r["n"] for r in labels.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("k")).agg(F.countDistinct(id_column).alias("n")).collect()}
    if len(share) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), 30.0 if 1 in share else -30.0)
    sample = settled(_sample(docs, labels, id_column, text, label, per_class), "labelled")
    sizes = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), 30.0 if 1 in sizes else -30.0)

    n0, n1 = sizes[0], sizes[1]
    table = sample.mapInArrow(_frequencies, "feature long, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    part = lambda k, n: f"if({k} > 0, {k} * ln({k} / ((a + b) * {n}D / {n0 + n1})), 0)"
    surprise = F.expr(f"2 * ({part('a', n0)} + {part('b', n1)})")
    prior = n1 / (n0 + n1)
    ratio = F.log((F.col("b") + SMOOTHING * prior) / prior) - F.log((F.col("a") + SMOOTHING * (1 - prior)) / (1 - prior))
    kept = table.where(surprise >= MIN_SURPRISE).select("feature", ratio.alias("ratio")).toPandas().sort_values("feature")
    known = np.zeros(1 << BITS, np.float64)
    known[kept.feature] = kept.ratio

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_chunks(batches, "text", CHUNK_BYTES):
            feature, owner, total = ngrams(texts)
            own = known[feature] != 0
            text_, feature, count = counted(feature[own], owner[own])
            value = np.log1p(count / total[text_] * PER)
            edges = np.searchsorted(text_, np.arange(len(texts) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in (feature.astype(np.int32), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column("_label").cast(pa.int32()), *lists], ["label", "feature", "value"])

    weights = (share[0] / n0, 2.0 * share[1] / n1)
    ratios = kept.ratio.to_numpy()
    places = kept.feature.to_numpy()

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label_, doc, feature, value = _gathered(batches, places, ratios)
        weight = np.where(label_ == 1, weights[1], weights[0])
        coefficients, intercept = _regression(doc, feature, value, label_, weight / weight.sum(), len(places), rounds)
        yield pa.RecordBatch.from_arrays([pa.array([coefficients.tolist()], pa.list_(pa.float64())), pa.array([intercept])], ["coefficients", "intercept"])

    # The sample is bounded, so one task can hold the kept features of its documents.
    found = sample.mapInArrow(rows, "label int, feature array<int>, value array<float>").repartition(1).mapInArrow(
        fit, "coefficients array<double>, intercept double").first()
    return Model(places, np.array(found["coefficients"]) * ratios, found["intercept"])


def _gathered(batches: Iterator[pa.RecordBatch], places: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the rows, and row, place of the feature and scaled value of every entry. Few rows at a time, so that hardly more than the result is held."""
    label, doc, feature, value = ([np.empty(0, t)] for t in (float, np.int32, np.int32, np.float32))
    done = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            own = batch.slice(begin, ROWS_AT_ONCE)
            lists = own.column("feature")
            feature.append(np.searchsorted(places, lists.flatten().to_numpy()).astype(np.int32))
            value.append(own.column("value").flatten().to_numpy() * ratios[feature[-1]].astype(np.float32))
            doc.append(np.repeat(np.arange(done, done + own.num_rows, dtype=np.int32), lists.value_lengths().to_numpy()))
            label.append(own.column("label").to_numpy().astype(float))
            done += own.num_rows
            del own, lists
        del batch
        give_back()
    joined = []
    for parts in (label, doc, feature, value):
        joined.append(np.concatenate(parts))
        parts.clear()
    return tuple(joined)


def _regression(doc, feature, value, label, weight, features: int, rounds: int, rate: float = 0.2, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch steps scaled by the root of the summed squared gradients."""
    w, b = np.zeros(features), 0.0
    seen_w, seen_b = np.full(features, 1e-8), 1e-8
    slices = [slice(i, i + AT_ONCE) for i in range(0, len(doc), AT_ONCE)]  # bounds what is held besides the sample
    for _ in range(rounds):
        sums = np.full(len(label), b)
        for k in slices:
            sums += np.bincount(doc[k], value[k] * w[feature[k]], len(label))
        error = (1 / (1 + np.exp(-np.clip(sums, -30, 30))) - label) * weight
        gradient = decay * w
        for k in slices:
            gradient += np.bincount(feature[k], value[k] * error[doc[k]], features)
        seen_w += gradient ** 2
        w -= rate * gradient / np.sqrt(seen_w)
        seen_b += error.sum() ** 2
        b -= rate * error.sum() / np.sqrt(seen_b)
    return w, float(b)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: likelier toxic) of every row; the whole text counts. Empty and null
    texts have no features and get the score of the intercept. Repeated rows stay."""
    features, coefficients, intercept = model.features, model.coefficients, model.intercept

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, np.float64)
        table[features] = coefficients
        kept = table != 0
        for batch, texts in texts_in_chunks(batches, "text", CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(table, kept, intercept, texts))], ["doc_id", "score"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scored, "doc_id long, score double")


def keep_below(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is scored below the threshold; null and empty texts are scored as ``score`` does."""
    features, coefficients, intercept, schema = model.features, model.coefficients, model.intercept, docs.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, np.float64)
        table[features] = coefficients
        known = table != 0
        for batch, texts in texts_in_chunks(batches, text, CHUNK_BYTES):
            yield batch.filter(pa.array(_scores(table, known, intercept, texts) < threshold))

    return docs.mapInArrow(kept, schema)


def held_out(column: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether crc32 of the id as text falls into the fold kept from training (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return score(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
