"""Lexical retrieval packing: sequences filled with a seed document and its BM25 neighbours.

Document frequencies and the mean length are those of all documents. Documents are dealt to
shards, of a bounded amount of text, by two weighted MinHash terms, rare ones first in line, so that
documents on one subject tend to lie together; what has both terms in common and is too much for a shard
is split by row. Each shard has its own inverted index of token ids, and neighbours come from it. A seed document asks the index with all
of its terms; unused neighbours fill the window best first. If none of them
fits into what is left, the best is cut and its rest stays unused. So every
sequence but the last of a shard is full. A document of more than a window
first gives full sequences of its own.

Ids: the tokenizer's without special tokens, then id 1. Sequences are padded to
the window, except where their length is a power of two.

Defined cases: null and empty texts are the end id alone; rows with a null id and
repeated rows are packed like others; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm.byte_words import mix
from ordersight.llm.pretokens import encoder
from ordersight.llm.tables import table, text_bytes
from ordersight.plans.shared_store import store

WINDOW = 2048
END = 1
#: Bytes of text in a shard.
SHARD_BYTES = 8 << 20
#: Tasks that fill shards; more shards are dealt to them in ranges.
MOST_TASKS = 200_000
K1, B = 1.2, 0.75
#: Terms in more than one of so many texts are rows of a shard's matrix, while it has at most so many cells.
SPARSE, MATRIX_CELLS = 32, 6 << 20
#: Seeds whose scores come from one product.
SEEDS_AT_ONCE = 32
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Statistics:
    """Number of documents, their mean length in ids, and in how many of them each id occurs."""

    def __init__(self, documents: int, mean: float, frequency: np.ndarray):
        self.documents, self.mean, self.frequency = documents, mean, frequency

    @property
    def rarity(self) -> np.ndarray:
        return np.log1p((self.documents - self.frequency + 0.5) / (self.frequency + 0.5))

    def ranks(self) -> np.ndarray:
        """Two weighted MinHash orders of the ids; an id in one document alone joins nothing and comes last."""
        draws = np.random.default_rng(29).exponential(size=(2, len(self.frequency)))
        return np.where(self.frequency > 1, draws / self.rarity, np.inf)


class Index:
    """BM25 postings of the texts of a shard, with the statistics of all documents.

    Gains are whole multiples of 2^-30, so that their sums are exact in any order. Terms in many
    texts are held as rows of a matrix, and the scores of several seeds come from one product.
    """

    def __init__(self, ids: list[np.ndarray], statistics: Statistics | None = None):
        sizes = np.array([len(x) for x in ids], np.int64)
        n = len(ids)
        keys = (np.concatenate(ids).astype(np.uint64) << np.uint64(32)) | np.repeat(np.arange(n, dtype=np.uint64), sizes)
        keys.sort()
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        times = np.diff(np.append(new, len(keys)))
        self.docs = (keys[new] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        terms = (keys[new] >> np.uint64(32)).astype(np.int64)
        self.first = np.searchsorted(terms, np.arange(int(terms.max()) + 2))
        statistics = statistics or Statistics(n, float(sizes.mean()), np.diff(self.first))
        norm = K1 * (1 - B + B * sizes / statistics.mean)
        self.gain = np.rint(statistics.rarity[terms] * times * (K1 + 1) / (times + norm[self.docs]) * 2.0**30) / 2.0**30
        #: The texts that are left; ``docs`` and scores count in them.
        self.texts = np.arange(n)
        self._arrange()

    def _arrange(self) -> None:
        """Choose the terms of the matrix; scores do not depend on the choice."""
        self.frequency = np.diff(self.first)
        n = len(self.texts)
        often = np.flatnonzero(self.frequency * SPARSE > n)
        often = often[np.argsort(-self.frequency[often], kind="stable")[: MATRIX_CELLS // max(n, 1)]]
        self._row = np.full(len(self.frequency), -1, np.int64)
        self._row[often] = np.arange(len(often))
        self._matrix = np.zeros((len(often), n))
        for row, term in enumerate(often):
            span = slice(self.first[term], self.first[term + 1])
            self._matrix[row, self.docs[span]] = self.gain[span]

    def scores(self, seeds: list[np.ndarray]) -> np.ndarray:
        """Per seed the BM25 scores of ``texts`` for all of its terms."""
        n = len(self.texts)
        out, asked = np.zeros((len(seeds), n)), np.zeros((len(seeds), len(self._matrix)))
        for k, ids in enumerate(seeds):
            terms = np.unique(ids)
            terms = terms[self.frequency[terms] > 0]
            rows = self._row[terms]
            asked[k, rows[rows >= 0]] = 1
            spans = [slice(self.first[t], self.first[t + 1]) for t in terms[rows < 0]]
            if spans:
                out[k] = np.bincount(np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.gain[s] for s in spans]), n)
        return out + asked @ self._matrix

    def neighbours(self, ids: np.ndarray, unused: np.ndarray) -> np.ndarray:
        """Unused texts by their BM25 score for all terms of ``ids``, best first."""
        scores = self.scores([ids])[0]
        found = np.flatnonzero((scores > 0) & unused[self.texts])
        return self.texts[found[np.argsort(-scores[found], kind="stable")]]

    def shrink(self, unused: np.ndarray) -> None:
        """Leave out used texts; scores of the others stay."""
        keep = unused[self.texts]
        kept = keep[self.docs]
        self.docs, self.gain = (np.cumsum(keep) - 1)[self.docs[kept]], self.gain[kept]
        self.first = np.append(0, np.cumsum(kept))[self.first]
        self.texts = self.texts[keep]
        self._arrange()


def pack(sizes: np.ndarray, ids: list[np.ndarray], window: int, statistics: Statistics | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of a shard as lists of (text, start, length)."""
    starts = np.zeros(len(sizes), np.int64)
    for text in np.flatnonzero(sizes >= window):
        for _ in range(int(sizes[text]) // window):
            yield [(int(text), int(starts[text]), window)]
            starts[text] += window
    left = sizes - starts
    unused = left > 0
    if not unused.any():
        return
    index = Index(ids, statistics)
    # Long rests first, so that short ones are there to fill what is left.
    order = np.argsort(-left, kind="stable")
    turn = 0
    remaining = int(unused.sum())
    scored: dict[int, np.ndarray] = {}
    while remaining:
        if remaining < 0.7 * len(index.texts):
            index.shrink(unused)
            scored = {}
        while not unused[order[turn]]:
            turn += 1
        seed = int(order[turn])
        pieces, room = [(seed, int(starts[seed]), int(left[seed]))], window - int(left[seed])
        if room and seed not in scored:
            ahead = order[turn : turn + 4 * SEEDS_AT_ONCE]
            ahead = ahead[unused[ahead]][: max(1, min(SEEDS_AT_ONCE, MATRIX_CELLS // len(index.texts)))]
            scored = dict(zip(ahead.tolist(), index.scores([ids[t] for t in ahead])))
        unused[seed] = False
        remaining -= 1
        # Scores of the texts that can still be taken, 0 for all others.
        score = np.where(unused[index.texts], scored.pop(seed), 0) if room and remaining else np.zeros(0)
        sizes_left = left[index.texts] if len(score) else score
        while room and len(score):
            fitting = np.where(sizes_left <= room, score, 0)
            best = int(fitting.argmax())
            if not fitting[best]:
                break
            score[best] = 0
            text = int(index.texts[best])
            pieces.append((text, int(starts[text]), int(left[text])))
            room -= int(left[text])
            unused[text] = False
            remaining -= 1
        at = turn
        while room and remaining:
            if len(score) and score.max():
                found = int(score.argmax())
                score[found] = 0
                best = int(index.texts[found])
            else:
                while not unused[order[at]]:
                    at += 1
                best = int(order[at])
            taken = min(room, int(left[best]))
            pieces.append((best, int(starts[best]), taken))
            starts[best] += taken
            left[best] -= taken
            room -= taken
            if not left[best]:
                unused[best] = False
                remaining -= 1
        yield pieces


def _pack_shard(shard: int, docs: list, ids: list[np.ndarray], window: int, statistics: Statistics) -> pa.RecordBatch:
    sizes = np.array([len(x) for x in ids], np.int64)
    rows = []
    for number, pieces in enumerate(pack(sizes, ids, window, statistics)):
        offset = 0
        for text, start, length in pieces:
            crc = zlib.crc32(ids[text][start : start + length].astype("<u4").tobytes())
            rows.append((docs[text], start, length, crc, int(sizes[text]), (shard << 32) + number, offset))
            offset += length
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b.as_py(), "<u2" if small.as_py() else "<u4") for small, b in zip(batch.column("small"), batch.column("ids"))]


def _coded(texts: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, row (its place in the input), bytes, small (16 bits an id) and the ids of each text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, row = encoder(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                coded = [np.append(x, END).astype("<u4") for x in coder.ids(part.column("text").to_pylist())]
                small = all(int(x.max()) < 1 << 16 for x in coded)
                blobs = [x.astype("<u2").tobytes() if small else x.tobytes() for x in coded]
                rows = pa.array(np.arange(row, row + len(blobs)))
                row += len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), rows, part.column("bytes"), pa.array(np.full(len(blobs), small)), pa.array(blobs, pa.binary())],
                    ["doc_id", "row", "bytes", "small", "ids"],
                )

    return store(texts.mapInArrow(encode, "doc_id long, row long, bytes long, small boolean, ids binary"))


def statistics_of(coded: DataFrame) -> Statistics:
    """Of all documents; one row an id and task is shuffled, and the driver gets one an id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Two sums share the column of the ids: documents at -1, ids of all texts at -2.
        total, documents, length = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for ids in _ids(batch):
                found = np.unique(ids)
                if found[-1] >= len(total):
                    total = np.append(total, np.zeros(int(found[-1]) + 1 - len(total), np.int64))
                total[found] += 1
                documents, length = documents + 1, length + len(ids)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(total[some], [documents, length]))], ["term", "n"])

    found = coded.select("small", "ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(found["term"].to_pylist(), found["n"].to_pylist()))
    documents, length = counts.pop(-1, 0), counts.pop(-2, 0)
    frequency = np.zeros(max(counts, default=0) + 1, np.int64)
    frequency[list(counts)] = list(counts.values())
    return Statistics(documents, length / max(documents, 1), frequency)


def _dealt(coded: DataFrame, statistics: Statistics) -> tuple[DataFrame, int]:
    """``coded`` with its shard, and the number of shards."""
    spark = coded.sparkSession
    ranks = spark.sparkContext.broadcast(statistics.ranks())

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = ranks.value
        for batch in batches:
            terms = [np.unique(ids) for ids in _ids(batch)]
            keys = [pa.array(np.array([t[np.argmin(rank[t])] for t in terms], np.int64)) for rank in (one, two)]
            yield pa.RecordBatch.from_arrays([*keys, batch.column("bytes")], ["one", "two", "bytes"])

    signed = coded.select("bytes", "small", "ids").mapInArrow(sign, "one long, two long, bytes long")
    cells = store(signed.groupBy("one", "two").agg(F.sum("bytes").alias("bytes")))
    # At most one cell a shard's bytes, and one sum an id of the vocabulary.
    crowded = {(r.one, r.two): r.bytes for r in cells.where(F.col("bytes") > SHARD_BYTES).orderBy("one", "two").collect()}
    sums = cells.where(F.col("bytes") <= SHARD_BYTES).groupBy("one").agg(F.sum("bytes").alias("bytes")).orderBy("one").collect()
    size, start, at = np.zeros(len(statistics.frequency), np.int64), np.zeros(len(statistics.frequency), np.int64), 0
    for r in sums:
        size[r.one], start[r.one] = r.bytes, at
        at += r.bytes
    shards, own = max(1, -(-at // SHARD_BYTES)), {}
    for cell, amount in crowded.items():
        own[cell] = (shards, -(-amount // SHARD_BYTES))
        shards += own[cell][1]
    plan = spark.sparkContext.broadcast((size, start, own))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), (size, start, own) = ranks.value, plan.value
        for batch in batches:
            terms = [np.unique(ids) for ids in _ids(batch)]
            a, b = (np.array([t[np.argmin(rank[t])] for t in terms], np.int64) for rank in (one, two))
            # The documents of a large first term lie in the order of a hash of the second.
            part = (mix(b.astype(np.uint64)) >> np.uint64(11)).astype(float) / (1 << 53)
            shard = (start[a] + np.where(size[a] > SHARD_BYTES, part * size[a], 0).astype(np.int64)) // SHARD_BYTES
            salt = mix(np.asarray(batch.column("row")).astype(np.uint64)) >> np.uint64(1)
            for k, cell in enumerate(zip(a.tolist(), b.tolist())):
                if cell in own:
                    first, count = own[cell]
                    shard[k] = first + int(salt[k]) % count
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", *batch.schema.names])

    return coded.mapInArrow(deal, "shard long, doc_id long, row long, bytes long, small boolean, ids binary"), shards


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pieces of sequences of all ``docs`` (doc_id, text); each id lies in exactly one piece."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    coded = _coded(texts.withColumn("bytes", text_bytes(F.col("text")) + 16), tokenizer)
    statistics = statistics_of(coded)
    dealt, shards = _dealt(coded, statistics)
    shared = spark.sparkContext.broadcast(statistics)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, docs, ids = None, [], []
        for batch in batches:
            for shard, doc, text in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), _ids(batch)):
                if shard != current and docs:
                    yield _pack_shard(current, docs, ids, window, shared.value)
                    docs, ids = [], []
                current = shard
                docs.append(doc)
                ids.append(text)
        if docs:
            yield _pack_shard(current, docs, ids, window, shared.value)

    # Each shard is a task of its own; beyond a number of tasks, ranges of shards are.
    parts = min(shards, MOST_TASKS)
    place = F.floor(F.col("shard") * F.lit(parts) / F.lit(shards)).cast("int")
    gathered = dealt.select("shard", "doc_id", "row", "small", "ids").repartitionById(parts, place).sortWithinPartitions("shard", "doc_id", "row")
    return gathered.mapInArrow(fill, _PIECES)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
