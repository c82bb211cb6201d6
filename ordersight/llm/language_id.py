"""Language identification by a convolutional network over bytes, in numpy.

A window of 128 bytes is embedded byte by byte; filters of widths 2, 3 and 4 run
over it, each keeps its largest response, and a softmax over these responses gives the
languages. A text is cut into windows that cover all its bytes (the last one ends
with the text; a shorter text is padded with zero bytes), scored in batches, and the
window probabilities are averaged.

Training uses a bounded sample: at most ``TRAIN_ROWS`` labelled documents, those of
the smallest hash of their id, with ``TRAIN_WINDOWS`` windows spread over each.

Defined cases: null texts and texts without a letter get ``und`` and score 0; so
does every text when there is nothing to learn from; rows with a null lang are
not learned from; a null id is scored and not held out; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.llm import byte_words
from ordersight.llm.tables import as_rows, first_of_each, id_remainder, table

TRAIN_ROWS = 3_000
TRAIN_WINDOWS = 3
WINDOW = 128
EMBEDDING = 8
FILTERS = 16
WIDTHS = (2, 3, 4)
EPOCHS = 3
BATCH = 128
#: Windows scored at once.
SCORED_AT_ONCE = 256
UNKNOWN = "und"


def _columns(x: np.ndarray, width: int) -> np.ndarray:
    """(windows, places, width * embedding) of an embedded batch."""
    n, length, size = x.shape
    view = np.lib.stride_tricks.as_strided(x, (n, length - width + 1, width * size), (x.strides[0], x.strides[1], x.strides[2]))
    return view.reshape(-1, width * size)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class ByteNetwork:
    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, draw: np.random.Generator) -> None:
        self.weights["embedding"] = draw.normal(0, 0.5, (256, EMBEDDING))
        for width in WIDTHS:
            fan = width * EMBEDDING
            self.weights[f"filter{width}"] = draw.normal(0, np.sqrt(2 / fan), (fan, FILTERS))
            self.weights[f"shift{width}"] = np.zeros(FILTERS)
        self.weights["out"] = draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(self.languages)))
        self.weights["bias"] = np.zeros(len(self.languages))
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def pooled(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter (before the shift and the cut at 0), and all responses."""
        places = x.shape[1] - width + 1
        responses = (_columns(x, width) @ self.weights[f"filter{width}"]).reshape(len(x), places, FILTERS)
        return responses.max(1), responses

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        x = self.weights["embedding"][windows]
        best = [np.maximum(self.pooled(x, w)[0] + self.weights[f"shift{w}"], 0) for w in WIDTHS]
        return _softmax(np.concatenate(best, axis=1) @ self.weights["out"] + self.weights["bias"])

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        x = self.weights["embedding"][windows]
        n = len(x)
        hidden, peaks = [], []
        for width in WIDTHS:
            _, responses = self.pooled(x, width)
            peak = responses.argmax(1)
            top = np.take_along_axis(responses, peak[:, None], 1)[:, 0]
            hidden.append(np.maximum(top + self.weights[f"shift{width}"], 0))
            peaks.append(peak)
        joined = np.concatenate(hidden, axis=1)
        error = _softmax(joined @ self.weights["out"] + self.weights["bias"])
        error[np.arange(n), labels] -= 1
        error /= n
        found = {"out": joined.T @ error, "bias": error.sum(0), "embedding": np.zeros_like(self.weights["embedding"])}
        back = (error @ self.weights["out"].T) * (joined > 0)
        for k, width in enumerate(WIDTHS):
            mine = back[:, k * FILTERS : (k + 1) * FILTERS]
            weights = self.weights[f"filter{width}"].reshape(width, EMBEDDING, FILTERS)
            found[f"shift{width}"] = mine.sum(0)
            steps = np.zeros_like(weights)
            for offset in range(width):
                bytes_there = np.take_along_axis(windows, peaks[k] + offset, 1)
                steps[offset] = np.einsum("nf,nfe->ef", mine, self.weights["embedding"][bytes_there])
                np.add.at(found["embedding"], bytes_there, mine[:, :, None] * weights[offset].T[None])
            found[f"filter{width}"] = steps.reshape(width * EMBEDDING, FILTERS)
        return found


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 11) -> ByteNetwork:
    """Adam over shuffled batches."""
    draw = np.random.default_rng(seed)
    network = ByteNetwork(languages)
    network.start(draw)
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    # Few rows get more passes, so that small tables are learned too.
    for _ in range(EPOCHS * max(1, 2_000 // len(labels))):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            for name, slope in network.gradients(windows[rows], labels[rows]).items():
                mean[name] = 0.9 * mean[name] + 0.1 * slope
                square[name] = 0.99 * square[name] + 0.01 * slope**2
                change = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
                network.weights[name] -= (0.01 * change).astype(np.float32)
    return network


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover every text of a chunk, and the text each is of."""
    sizes = np.diff(offsets)
    counts = np.maximum(-(-sizes // WINDOW), 1)
    owners = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[:-1][owners] + np.maximum(np.minimum(number * WINDOW, sizes[owners] - WINDOW), 0)
    padded = np.append(data, np.zeros(WINDOW, np.uint8))
    windows = padded[begins[:, None] + np.arange(WINDOW)]
    short = np.flatnonzero(sizes[owners] < WINDOW)
    windows[short] *= np.arange(WINDOW) < sizes[owners[short], None]
    return windows, owners


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> ByteNetwork | None:
    """Fit on at most ``rows`` rows of ``labelled`` (doc_id, text, lang); of rows that share an id on one of them."""
    known = labelled.where("lang is not null and text is not null and doc_id is not null")
    keys = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = known.join(F.broadcast(keys), "doc_id").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = []
            for _, data, offsets in byte_words.chunks(batch.column("text")):
                windows, owners = cut_windows(data, offsets)
                bounds = np.searchsorted(owners, np.arange(len(offsets)))
                taken += [windows[np.unique(np.linspace(a, b - 1, TRAIN_WINDOWS).astype(int))].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(taken, pa.binary()), batch.column("lang")], ["doc_id", "bytes", "lang"])

    found = first_of_each(chosen.mapInArrow(sample, "doc_id long, bytes binary, lang string"), "doc_id").toArrow()
    if found.num_rows == 0:
        return None
    cut = [[b[k : k + WINDOW] for k in range(0, len(b), WINDOW)] for b in found["bytes"].to_pylist()]
    at = pa.array(np.repeat(np.arange(len(cut)), [len(c) for c in cut]))
    found = found.select(["doc_id", "lang"]).take(at).append_column("bytes", pa.array([w for c in cut for w in c], pa.binary()))
    found = found.sort_by([("doc_id", "ascending"), ("bytes", "ascending")])
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    windows = np.frombuffer(b"".join(found["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    return fit(windows, np.array([languages.index(n) for n in names]), languages)


def identify_language(docs: DataFrame, network: ByteNetwork | None, *columns: str) -> DataFrame:
    """``row`` (the named columns of ``docs``, with ``text``), ``lang_pred`` and ``score``."""
    rows = as_rows(docs, *columns)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    schema = T.StructType([rows.schema["row"], T.StructField("guess", T.StringType()), T.StructField("chance", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            guesses, chances = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if network is not None:
                for first, data, offsets in byte_words.chunks(batch.column("row").field("text")):
                    windows, owners = cut_windows(data, offsets)
                    parts = [network.probabilities(windows[k : k + SCORED_AT_ONCE]) for k in range(0, len(windows), SCORED_AT_ONCE)]
                    starts = np.searchsorted(owners, np.arange(len(offsets) - 1))
                    total = np.add.reduceat(np.concatenate(parts).astype(np.float64), starts, axis=0)
                    mean = total / np.bincount(owners)[:, None]
                    best = mean.argmax(1)
                    past = first + len(best)
                    guesses[first:past] = [network.languages[b] for b in best]
                    chances[first:past] = np.clip(mean[np.arange(len(best)), best], 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(guesses), pa.array(chances)], ["row", "guess", "chance"])

    lettered = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    return rows.mapInArrow(score, schema).select(
        "row",
        F.when(lettered, F.col("guess")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(lettered, F.col("chance")).otherwise(0.0).alias("score"),
    )


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = train(docs.where(id_remainder(F.col("doc_id"), 3) != 1).select("doc_id", "text", "lang"))
    found = identify_language(docs, network, "doc_id", "text")
    doc_id = F.col("row.doc_id")
    return found.select(
        doc_id.alias("doc_id"), F.coalesce(id_remainder(doc_id, 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
