"""Benchmark decontamination by a prefix-filtered set join.

An item-sized window of ten item words can only occur in a document that holds
all its shingles, so looking for its rarest shingle alone (the necessary prefix
at containment 1) loses nothing. Rarity is counted over all documents. Each
place of that shingle gives one possible place of the window, which must lie
inside the document (length and position bounds) and is then compared word by
word.

The benchmark is cut into blocks of at most ``BLOCK_PAIRS`` (window, item)
pairs; every block is sent to all tasks and passes over all documents. Documents are never
shuffled, so neither a long text nor a frequent passage lands in one task.

Defined cases: a null or empty text has no words; a null item id or an item
without words has no windows; repeated documents are each judged on their own;
an empty benchmark hits nothing; equal windows of several items count for all
of these items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.llm import byte_words
from ordersight.llm.tables import as_rows, table

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
BLOCK_PAIRS = 100_000


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct (window as words joined by a blank, item_id)."""
    words = F.expr(r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)")
    listed = (
        benchmark.select("item_id", F.col("text").cast("string").alias("text"))
        .where("item_id is not null and text is not null")
        .select("item_id", words.alias("words"))
        .where("size(words) > 0")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    window = F.transform(starts, lambda at: F.array_join(F.slice("words", at, size), " "))
    return listed.select("item_id", F.explode(F.array_distinct(window)).alias("window")).distinct()


class _Block:
    """The windows of one block and their shingles; small enough to be sent to all tasks."""

    def __init__(self, pairs: list[tuple[str, int]]):
        items: dict[str, list[int]] = {}
        for window, item in sorted(pairs):
            items.setdefault(window, []).append(item)
        self.windows = [window.encode() for window in items]
        self.items = list(items.values())
        data = np.frombuffer(b"\n".join(self.windows), np.uint8)
        offsets = np.cumsum([0] + [len(w) + 1 for w in self.windows])
        offsets[-1] = len(data)
        found = byte_words.words(data, offsets)
        self.n_words = found.counts
        tokens, sizes, owners, places = [], [], [], []
        for size in range(1, SHINGLE_WORDS + 1):
            # Windows shorter than a shingle are one shingle of their own length.
            mine = np.flatnonzero(np.minimum(self.n_words, SHINGLE_WORDS) == size)
            if not len(mine):
                continue
            hashes, owner = byte_words.shingles(found, size)
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            chosen = np.isin(owner, mine)
            tokens.append(hashes[chosen])
            owners.append(owner[chosen])
            places.append(place[chosen])
            sizes.append(np.full(chosen.sum(), size))
        none = np.zeros(0, np.int64)
        self.tokens = np.concatenate([none.astype(np.uint64), *tokens])
        self.owners, self.places, self.sizes = (np.concatenate([none, *x]) for x in (owners, places, sizes))

    def keep_rarest(self, counted: dict[int, int]) -> None:
        """Of each window keep the shingle that the fewest documents hold."""
        frequency = np.array([counted.get(int(t), 0) for t in self.tokens.view(np.int64)])
        order = np.lexsort((self.places, self.tokens, frequency, self.owners))
        order = order[np.unique(self.owners[order], return_index=True)[1]]
        order = order[np.lexsort((self.tokens[order], self.sizes[order]))]
        for name in ("tokens", "owners", "places", "sizes"):
            setattr(self, name, getattr(self, name)[order])

    def by_size(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(words in a shingle, sorted shingles, their rows)."""
        rows = [(s, np.flatnonzero(self.sizes == s)) for s in np.unique(self.sizes)]
        rows = [(int(s), r[np.argsort(self.tokens[r], kind="stable")]) for s, r in rows]
        return [(s, self.tokens[r], r) for s, r in rows]


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("row").field("text")


def _document_frequency(docs: DataFrame, shared) -> DataFrame:
    """(token, documents with it) of the shingles of the block ``shared``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [(size, np.unique(tokens)) for size, tokens, _ in shared.value.by_size()]
        totals = [np.zeros(len(tokens), np.int64) for _, tokens in groups]
        for batch in batches:
            for _, data, offsets in byte_words.chunks(_texts(batch)):
                found = byte_words.words(data, offsets)
                for (size, tokens), total in zip(groups, totals):
                    hashes, owners = byte_words.shingles(found, size)
                    at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                    hit = tokens[at] == hashes
                    pairs = np.unique(owners[hit] * len(tokens) + at[hit])
                    total += np.bincount(pairs % len(tokens), minlength=len(tokens))
        for (_, tokens), total in zip(groups, totals):
            some = total > 0
            yield pa.RecordBatch.from_arrays([pa.array(tokens[some].view(np.int64)), pa.array(total[some])], ["token", "n"])

    counted = docs.mapInArrow(count, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _merge(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [{"first": start, "past": end} for start, end in merged]


def _block_hits(block: _Block, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, list], dict[int, set]]:
    """Word counts, and per row of the chunk with hits its spans of words and its items."""
    found = byte_words.words(data, offsets)
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    owners = found.owners()
    for size, tokens, rows in block.by_size():
        n = len(found.hashes) - size + 1
        if n <= 0:
            continue
        hashes, _ = byte_words.shingles(found, size)
        places = np.flatnonzero(owners[:n] == owners[size - 1 :])
        low = np.searchsorted(tokens, hashes, "left")
        is_prefix = tokens[np.minimum(low, len(tokens) - 1)] == hashes
        places, low, hashes = places[is_prefix], low[is_prefix], hashes[is_prefix]
        high = np.searchsorted(tokens, hashes, "right")
        for place, first, past in zip(places.tolist(), low.tolist(), high.tolist()):
            row = int(owners[place])
            for at in rows[first:past]:
                window = int(block.owners[at])
                start = place - int(block.places[at])
                end = start + int(block.n_words[window])
                if start < found.bounds[row] or end > found.bounds[row + 1]:
                    continue
                there = data[found.starts[start] : found.ends[end - 1]].tobytes().translate(byte_words.SPACED)
                if b" ".join(there.split()) == block.windows[window]:
                    base = int(found.bounds[row])
                    spans.setdefault(row, []).append((start - base, end - base))
                    items.setdefault(row, set()).update(block.items[window])
    return found.counts, spans, items


_ADDED = "n_words long, spans array<struct<first:long,past:long>>, items array<long>"


def _with_hits(rows: DataFrame, shared) -> DataFrame:
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(_ADDED).fields])
    span_type = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            counts = np.zeros(size, np.int64)
            spans: list[list] = [[] for _ in range(size)]
            items: list[list] = [[] for _ in range(size)]
            if "spans" in batch.schema.names:
                spans = [[(s["first"], s["past"]) for s in row] for row in batch.column("spans").to_pylist()]
                items = batch.column("items").to_pylist()
            for first, data, offsets in byte_words.chunks(_texts(batch)):
                n_words, new_spans, new_items = _block_hits(shared.value, data, offsets)
                counts[first : first + len(n_words)] = n_words
                for row, more in new_spans.items():
                    spans[first + row] = spans[first + row] + more
                for row, more in new_items.items():
                    items[first + row] = sorted({*items[first + row], *more})
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(counts),
                    pa.array([_merge(row) for row in spans], span_type),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                ["row", "n_words", "spans", "items"],
            )

    return rows.mapInArrow(find, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *columns: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``row`` (the named columns of ``docs``, with ``text``), ``n_words``, ``spans``, ``items``.

    ``spans`` are the maximal runs of hit words as (first, past) word numbers,
    ``items`` the sorted item ids with a window in the document.
    """
    spark = docs.sparkSession
    pairs = _windows(benchmark, WINDOW_WORDS).cache()
    n_blocks = max(1, -(-pairs.count() // block_pairs))
    rows = as_rows(docs, *columns)
    texts = as_rows(docs, "text")
    block_of = F.pmod(F.xxhash64("window", "item_id"), F.lit(n_blocks))
    for number in range(n_blocks):
        mine = [(r.window, r.item_id) for r in pairs.where(block_of == number).toLocalIterator()]
        block = _Block(mine)
        counted = _document_frequency(texts, spark.sparkContext.broadcast(block)).toArrow()
        block.keep_rarest(dict(zip(counted["token"].to_pylist(), counted["n"].to_pylist())))
        rows = _with_hits(rows, spark.sparkContext.broadcast(block))
    pairs.unpersist()
    return rows


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), "doc_id", "text")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["past"] - s["first"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[pos:pos + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS pos FROM doc_words, sizes)),
hits AS (SELECT doc_id, pos, i.n, item_id FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.n = i.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
