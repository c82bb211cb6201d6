"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other; the model of a category
sees the words of a text and the probabilities of the earlier categories. In
training these probabilities are out of fold: each training row gets them from
models that were fitted without it, so a later model learns to trust them no more
than they deserve. Scoring then uses models fitted on all training rows.

The features of a text are its distinct words, their beginnings of four and six bytes
(both hashed) and structure statistics. A model keeps the hashed features
whose document frequency differs most surely between the two sides.

Categories of ``op1_toxicity``, from the table ``labels``: ``flagged`` (toxic or of
low quality), ``toxic``, ``severe`` (both at once).

At most ``TRAIN_ROWS`` labelled rows are learned from, those of the smallest hash of their
id; scoring covers every row and the whole text.

Defined cases: null and empty texts have no words and are scored by their
structure; rows without labels are not learned from; repeated rows are scored alike;
a category without examples of both kinds gets its share (0 without any labels).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.llm import byte_words, quality_model
from ordersight.llm.tables import as_rows, first_of_each, table

CATEGORIES = ("flagged", "toxic", "severe")
TRAIN_ROWS = 12_000
SLOT_BITS = 20
BEGINNINGS = (4, 6)
FOLDS = 3
EPOCHS = 25
#: Least standard deviations by which a kept feature's frequency differs between the sides.
SURE = 4.0
TOXIC = 0.5


@dataclass
class Features:
    """Of several texts: distinct hashed features (text by text, ``bounds``) and statistics."""

    slots: np.ndarray
    bounds: np.ndarray
    statistics: np.ndarray

    def rows(self, chosen: np.ndarray) -> Features:
        counts = np.diff(self.bounds)[chosen]
        first = np.repeat(self.bounds[:-1][chosen] - (np.cumsum(counts) - counts), counts)
        return Features(self.slots[first + np.arange(counts.sum())], np.append(0, np.cumsum(counts)), self.statistics[chosen])


def features(data: np.ndarray, offsets: np.ndarray) -> Features:
    rows = len(offsets) - 1
    found = byte_words.words(data, offsets)
    ranges = byte_words.RangeHash(data, lower=True)
    hashes, owners = [found.hashes], [found.owners()]
    for size in BEGINNINGS:
        longer = found.ends - found.starts > size
        hashes.append(byte_words.mix(ranges.of(found.starts[longer], found.starts[longer] + size) + np.uint64(size)))
        owners.append(owners[0][longer])
    slots = (np.concatenate(hashes) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    keys = np.unique(np.concatenate(owners) << SLOT_BITS | slots)
    statistics = quality_model.features(data, offsets, np.diff(offsets)).statistics
    return Features((keys & ((1 << SLOT_BITS) - 1)).astype(np.int32), np.searchsorted(keys >> SLOT_BITS, np.arange(rows + 1)), statistics)


@dataclass
class Linear:
    """Logistic model; ``slots`` are the kept hashed features in ascending order."""

    slots: np.ndarray
    weights: np.ndarray
    dense_weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def probability(self, x: Features, earlier: np.ndarray) -> np.ndarray:
        total = np.clip((_dense(x, earlier) - self.mean) / self.scale, -8, 8) @ self.dense_weights + self.bias
        if len(self.slots):
            at = np.minimum(np.searchsorted(self.slots, x.slots), len(self.slots) - 1)
            values = np.where(self.slots[at] == x.slots, self.weights[at], 0.0)
            total += byte_words.segment_sums(values, x.bounds)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _dense(x: Features, earlier: np.ndarray) -> np.ndarray:
    clipped = np.clip(earlier, 1e-4, 1 - 1e-4)
    return np.column_stack([x.statistics, np.log(clipped / (1 - clipped))])


def fit_linear(x: Features, earlier: np.ndarray, y: np.ndarray, seed: int = 3) -> Linear:
    """Choose the features, then gradient steps with per-weight step sizes (AdaGrad) and weight decay."""
    n, positive = len(y), float(y.sum())
    dense = _dense(x, earlier)
    mean, scale = dense.mean(0), np.maximum(dense.std(0), 1e-3)
    share = positive / n
    if positive in (0.0, float(n)):
        return Linear(np.zeros(0, np.int32), np.zeros(0), np.zeros(dense.shape[1]), 40.0 if share else -40.0, mean, scale)
    sides = np.repeat(y, np.diff(x.bounds))
    size = 1 << SLOT_BITS
    with_, of_positive = np.bincount(x.slots, minlength=size), np.bincount(x.slots, sides, size)
    expected = with_ * share
    sure = np.abs(of_positive - expected) / np.sqrt(np.maximum(expected * (1 - share), 0.25))
    kept = np.flatnonzero((sure >= SURE) & (with_ >= 5))
    at = np.searchsorted(kept, x.slots)
    hit = kept[np.minimum(at, len(kept) - 1)] == x.slots if len(kept) else np.zeros(len(x.slots), bool)
    columns = at[hit]
    bounds = np.append(0, np.cumsum(hit))[x.bounds]
    scaled = np.clip((dense - mean) / scale, -8, 8)
    model = Linear(kept.astype(np.int32), np.zeros(len(kept)), np.zeros(dense.shape[1]), float(np.log(share / (1 - share))), mean, scale)
    seen, seen_dense, seen_bias = np.full(len(kept), 1e-3), np.full(dense.shape[1], 1e-3), 1e-3
    draw = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = draw.permutation(n)
        for first in range(0, n, 256):
            rows = order[first : first + 256]
            counts = np.diff(bounds)[rows]
            start = np.repeat(bounds[:-1][rows] - (np.cumsum(counts) - counts), counts)
            mine = columns[start + np.arange(counts.sum())]
            owner = np.repeat(np.arange(len(rows)), counts)
            total = np.bincount(owner, model.weights[mine], len(rows)) + scaled[rows] @ model.dense_weights + model.bias
            error = (1 / (1 + np.exp(-np.clip(total, -40, 40))) - y[rows]) / len(rows)
            slope = np.bincount(mine, error[owner], len(kept)) + 1e-5 * model.weights
            slope_dense = error @ scaled[rows] + 1e-4 * model.dense_weights
            seen, seen_dense, seen_bias = seen + slope**2, seen_dense + slope_dense**2, seen_bias + error.sum() ** 2
            model.weights -= 0.1 * slope / np.sqrt(seen)
            model.dense_weights -= 0.05 * slope_dense / np.sqrt(seen_dense)
            model.bias -= 0.1 * error.sum() / np.sqrt(seen_bias)
    return model


def fit_chain(x: Features, labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model a category; the earlier probabilities of training rows are out of fold."""
    models, earlier = [], np.zeros((len(labels), 0))
    for category in range(labels.shape[1]):
        y = labels[:, category].astype(float)
        models.append(fit_linear(x, earlier, y))
        if category + 1 < labels.shape[1]:
            held = np.zeros(len(labels))
            for fold in np.unique(folds):
                inside, outside = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
                source = outside if len(outside) else inside
                model = fit_linear(x.rows(source), earlier[source], y[source])
                held[inside] = model.probability(x.rows(inside), earlier[inside])
            earlier = np.column_stack([earlier, held])
    return models


def chain_probabilities(models: list[Linear], x: Features) -> np.ndarray:
    found = np.zeros((len(x.statistics), 0))
    for model in models:
        found = np.column_stack([found, model.probability(x, found)])
    return found


def train(docs: DataFrame, labelled: DataFrame, categories: tuple[str, ...], rows: int = TRAIN_ROWS) -> list[Linear] | None:
    """Fit on at most ``rows`` rows of ``labelled`` (doc_id and a 0/1 column per category).

    Of documents that share an id one is learned from, so the driver gets at most ``rows`` of them.
    """
    known = labelled.where("doc_id is not null").dropna(subset=list(categories))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", *categories).limit(rows)
    # At most `rows` keys, so they are sent to the documents rather than these to them.
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    joined = joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.array(*[F.col(c).cast("int") for c in categories]).alias("labels"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(data, offsets) for _, data, offsets in byte_words.chunks(batch.column("text"))]
            slots = [x.slots[a:b].tobytes() for x in found for a, b in zip(x.bounds, x.bounds[1:])]
            stats = [s.tobytes() for x in found for s in x.statistics]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(slots, pa.binary()), pa.array(stats, pa.binary()), batch.column("labels")], ["doc_id", "slots", "stats", "labels"]
            )

    extracted = joined.mapInArrow(extract, "doc_id long, slots binary, stats binary, labels array<int>")
    found = first_of_each(extracted, "doc_id", "labels").toArrow()
    if found.num_rows == 0:
        return None
    found = found.sort_by("doc_id")
    slots = [np.frombuffer(s, np.int32) for s in found["slots"].to_pylist()]
    x = Features(np.concatenate(slots), np.append(0, np.cumsum([len(s) for s in slots])), np.array([np.frombuffer(s) for s in found["stats"].to_pylist()]))
    # By text, so that copies of one lie in one fold.
    folds = np.array([zlib.crc32(s.tobytes()) % FOLDS for s in slots])
    return fit_chain(x, np.array(found["labels"].to_pylist()), folds)


def score_toxicity(docs: DataFrame, models: list[Linear] | None, categories: tuple[str, ...], *columns: str) -> DataFrame:
    """``row`` (the named columns, with ``text``) and ``p_<category>`` of every document."""
    rows = as_rows(docs, *columns)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = [f"p_{c}" for c in categories]
    schema = T.StructType([rows.schema["row"], *(T.StructField(n, T.DoubleType()) for n in names)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            parts = [np.zeros((0, len(names)))]
            if models is None:
                parts.append(np.zeros((batch.num_rows, len(names))))
            else:
                parts += [chain_probabilities(models, features(data, offsets)) for _, data, offsets in byte_words.chunks(batch.column("row").field("text"))]
            found = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(found[:, k].copy()) for k in range(len(names)))], ["row", *names])

    return rows.mapInArrow(score, schema)


def category_labels(labels: DataFrame) -> DataFrame:
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    return labels.select("doc_id", (toxic | poor).cast("int").alias("flagged"), toxic.cast("int").alias("toxic"), (toxic & poor).cast("int").alias("severe"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    models = train(docs, category_labels(table(spark, folder, "labels")), CATEGORIES)
    scored = score_toxicity(docs, models, CATEGORIES, "doc_id", "text")
    return scored.select(F.col("row.doc_id").alias("doc_id"), *[f"p_{c}" for c in CATEGORIES], (F.col("p_toxic") >= TOXIC).alias("toxic"))
