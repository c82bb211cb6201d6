"""Quality classifier: a factorisation machine over words, structure and metadata.

Features of a text: its distinct words (hashed, weighted so that their squares
sum to 1), structure statistics of the whole text, and the length the table
states (``n_chars``). Pairwise interactions have rank ``FACTORS``; with the identity
sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i x_i|^2) / 2 a text is
scored in time linear in its words.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, those of the smallest
hash of their id; scoring covers every row and the whole text.

Defined cases: null and empty texts have no words and are scored by their
structure; a null ``n_chars`` counts as 0; rows without a label are not learned
from; repeated rows are scored alike; without labelled rows of both kinds the
score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.llm import byte_words
from ordersight.llm.tables import as_rows, first_of_each, id_remainder, table

TRAIN_ROWS = 12_000
WORD_BITS = 17
FACTORS = 8
EPOCHS = 6
GOOD = 0.3

_CLASSES = np.zeros(256, np.uint8)
_CLASSES[97:123] = 1
_CLASSES[65:91] = 2
_CLASSES[48:58] = 3
_CLASSES[128:] = 4
_CLASSES[[9, 32]] = 5
_CLASSES[[10, 13]] = 6
_CLASSES[[ord(c) for c in "!#$%&*@|<>{}[]\\^~=+_/"]] = 7
STATISTICS = (
    "bias_length", "lower", "upper", "digit", "non_ascii", "blank", "line_end", "symbol", "other",
    "word_length", "distinct_words", "distinct_pairs", "distinct_lines", "symbol_runs", "stated_length", "empty",
)


def _distinct(owners: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, hash) pairs sorted by owner, and their number per owner."""
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    owners, hashes = owners[new], hashes[new]
    return owners, hashes, np.bincount(owners, minlength=rows)


@dataclass
class Features:
    """Of the texts of a chunk: hashed distinct words (row by row, ``bounds``) and statistics."""

    slots: np.ndarray
    bounds: np.ndarray
    statistics: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray, stated: np.ndarray) -> Features:
    rows = len(offsets) - 1
    found = byte_words.words(data, offsets)
    owners = found.owners()
    _, hashes, distinct = _distinct(owners, found.hashes, rows)
    pairs, pair_owners = byte_words.shingles(found, 2)
    distinct_pairs = _distinct(pair_owners, pairs, rows)[2]
    kinds = _CLASSES[data]
    size = np.diff(offsets)
    text_of = np.repeat(np.arange(rows), size)
    share = np.bincount(text_of * 8 + kinds, minlength=rows * 8).reshape(rows, 8) / np.maximum(size, 1)[:, None]
    runs = (kinds == 7).astype(np.int8)
    runs[1:] &= kinds[:-1] == 7
    # Lines: between line ends, by content.
    ends = np.union1d(np.flatnonzero(data == 10), offsets[1:] - 1)
    ends = ends[ends >= 0]
    begins = np.append(0, ends[:-1] + 1)[: len(ends)]
    line_hashes = byte_words.mix(byte_words.RangeHash(data, lower=False).of(begins, ends))
    line_owner = np.searchsorted(offsets, begins, "right") - 1
    lines = np.bincount(line_owner, minlength=rows) if len(ends) else np.zeros(rows)
    distinct_lines = _distinct(line_owner, line_hashes, rows)[2] if len(ends) else np.zeros(rows)
    n_words = found.counts
    letters = byte_words.segment_sums(found.ends - found.starts, found.bounds)
    statistics = np.column_stack(
        [
            np.log1p(size) / 10,
            share[:, 1], share[:, 2], share[:, 3], share[:, 4], share[:, 5], share[:, 6], share[:, 7], share[:, 0],
            np.minimum(letters / np.maximum(n_words, 1) / 10, 3),
            distinct / np.maximum(n_words, 1),
            distinct_pairs / np.maximum(n_words - 1, 1),
            distinct_lines / np.maximum(lines, 1),
            np.minimum(byte_words.segment_sums(runs, offsets) / np.maximum(n_words, 1), 3),
            np.log1p(np.maximum(stated, 0)) / 10,
            size == 0,
        ]
    )
    slots = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    return Features(slots, np.append(0, np.cumsum(distinct)), statistics)


@dataclass
class Machine:
    """w0 + <w, x> + (|V'x|^2 - sum |v_i x_i|^2) / 2 over words and standardised statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def _sums(self, x: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(x.bounds) - 1
        words = len(self.weights) - x.statistics.shape[1]
        dense = np.clip((x.statistics - self.mean) / self.scale, -8, 8)
        counts = np.diff(x.bounds)
        value = 1 / np.sqrt(np.maximum(counts, 1))
        linear, paired, squared = np.zeros(n), np.zeros((n, FACTORS)), np.zeros(n)
        some = np.flatnonzero(counts)
        if len(some):
            starts = x.bounds[:-1][some]
            linear[some] = np.add.reduceat(self.weights[x.slots], starts) * value[some]
            chosen = self.factors[x.slots]
            paired[some] = np.add.reduceat(chosen, starts, axis=0) * value[some, None]
            squared[some] = np.add.reduceat((chosen * chosen).sum(1), starts) * value[some] ** 2
        linear += dense @ self.weights[words:]
        paired += dense @ self.factors[words:]
        squared += (dense * dense) @ (self.factors[words:] ** 2).sum(1)
        return linear, paired, squared, dense, value

    def score(self, x: Features) -> np.ndarray:
        linear, paired, squared, _, _ = self._sums(x)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + ((paired**2).sum(1) - squared) / 2, -40, 40)))


def fit(parts: list[Features], labels: np.ndarray, seed: int = 7) -> Machine:
    """Mini-batch gradient steps with per-weight step sizes (AdaGrad) and weight decay."""
    statistics = np.concatenate([p.statistics for p in parts])
    dims = statistics.shape[1]
    slots = np.concatenate([p.slots for p in parts])
    counts = np.concatenate([np.diff(p.bounds) for p in parts])
    bounds = np.append(0, np.cumsum(counts))
    words = 1 << WORD_BITS
    draw = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(words + dims),
        draw.normal(0, 0.02, (words + dims, FACTORS)),
        statistics.mean(0),
        np.maximum(statistics.std(0), 1e-3),
    )
    seen_w, seen_v, seen_b = np.full(words + dims, 1e-2), np.full((words + dims, FACTORS), 1e-2), 1e-2
    dense_at = np.arange(words, words + dims)
    for epoch in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            chosen = [slots[bounds[r] : bounds[r + 1]] for r in rows]
            x = Features(np.concatenate(chosen), np.append(0, np.cumsum(counts[rows])), statistics[rows])
            _, paired, _, dense, value = machine._sums(x)
            error = machine.score(x) - labels[rows]
            per_word = np.repeat(error * value, counts[rows])
            ids, back = np.unique(x.slots, return_inverse=True)
            used = np.concatenate([ids, dense_at])
            step_w = np.concatenate([np.bincount(back, per_word, len(ids)), error @ dense]) / len(rows)
            inner = np.repeat(paired, counts[rows], axis=0) - machine.factors[x.slots] * np.repeat(value, counts[rows])[:, None]
            inner *= per_word[:, None]
            for_words = np.column_stack([np.bincount(back, inner[:, k], len(ids)) for k in range(FACTORS)])
            for_dense = dense.T @ (error[:, None] * paired) - machine.factors[words:] * (error @ dense**2)[:, None]
            step_v = np.concatenate([for_words, for_dense]) / len(rows)
            step_w += 1e-5 * machine.weights[used]
            step_v += 1e-4 * machine.factors[used]
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            seen_b += error.mean() ** 2
            machine.weights[used] -= 0.15 * step_w / np.sqrt(seen_w[used])
            machine.factors[used] -= 0.03 * step_v / np.sqrt(seen_v[used])
            machine.bias -= 0.15 * error.mean() / np.sqrt(seen_b)
    machine.weights = machine.weights.astype(np.float32)
    machine.factors = machine.factors.astype(np.float32)
    return machine


def _batch_features(batch: pa.RecordBatch) -> Iterator[Features]:
    row = batch.column("row")
    stated = np.nan_to_num(np.asarray(row.field("n_chars").cast(pa.float64()).fill_null(0.0)))
    for first, data, offsets in byte_words.chunks(row.field("text")):
        yield features(data, offsets, stated[first : first + len(offsets) - 1])


def _with_length(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.lit(None).cast("long"))


def train(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS) -> Machine | float:
    """Fit on at most ``rows`` rows of ``labelled`` (doc_id, label), those of the smallest id hash.

    Of documents that share an id one is learned from, so the driver gets at most ``rows`` of them.
    Without both labels the result is a constant score.
    """
    chosen = labelled.where("label in (0, 1) and doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    # At most `rows` keys, so they are sent to the documents rather than these to them.
    joined = _with_length(docs).select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")
    joined = joined.select(F.struct(F.col("text").cast("string").alias("text"), "n_chars").alias("row"), "doc_id", "label")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_batch_features(batch))
            slots = [x.slots[a:b].tobytes() for x in found for a, b in zip(x.bounds, x.bounds[1:])]
            stats = [s.tobytes() for x in found for s in x.statistics]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(slots, pa.binary()), pa.array(stats, pa.binary()), batch.column("label").cast(pa.int32())],
                ["doc_id", "slots", "stats", "label"],
            )

    extracted = joined.mapInArrow(extract, "doc_id long, slots binary, stats binary, label int")
    found = first_of_each(extracted, "doc_id", "label").toArrow()
    if found.num_rows == 0:
        return 0.5
    found = found.sort_by("doc_id")
    labels = found["label"].to_numpy().astype(float)
    if labels.min() == labels.max():
        return float(labels[0])
    slots = [np.frombuffer(s, np.int32) for s in found["slots"].to_pylist()]
    stats = np.array([np.frombuffer(s) for s in found["stats"].to_pylist()])
    bounds = np.append(0, np.cumsum([len(s) for s in slots]))
    return fit([Features(np.concatenate(slots), bounds, stats)], labels)


def score_quality(docs: DataFrame, model: Machine | float, *columns: str) -> DataFrame:
    """``row`` (the named columns of ``docs``) and ``score`` of every document."""
    kept = list(columns or docs.columns)
    docs = _with_length(docs)
    rows = as_rows(docs, *dict.fromkeys([*kept, "text", "n_chars"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if isinstance(model, float):
                scores = np.full(batch.num_rows, model)
            else:
                scores = np.concatenate([np.zeros(0), *(model.score(x) for x in _batch_features(batch))])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    return rows.mapInArrow(score, schema)


def quality_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) to learn from: ids whose crc32 modulo 5 is not 0."""
    return labels.where(id_remainder(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, quality_labels(table(spark, folder, "labels")))
    scored = score_quality(docs, model, "doc_id", "text", "n_chars")
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id.alias("doc_id"),
        F.coalesce(id_remainder(doc_id, 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
