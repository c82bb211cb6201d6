"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

The set of a document are its shingles of five words (all its words if it has
fewer), each weighing its count times ln(1 + N / max(df, N / 200)): what is in
less than one of 200 documents weighs the same, what is in more weighs less. Only
the frequent shingles are listed: at most 200 times the mean number of shingles of a
document, however many documents there are. They are found exactly, by a counting
sketch that never counts too little and a second count of what it lets through.

Each of ``SAMPLES`` samples draws per shingle r, c ~ Gamma(2, 1) and beta ~ U(0, 1), takes
t = floor(ln w / r + beta) and keeps the shingle of the smallest
ln c - r (t + 1 - beta); two documents keep the same (shingle, t) with a
probability of their weighted Jaccard similarity. The draws are looked up in a table by 16
bits of the shingle's hash for the sample. Samples are banded; equal texts are
one document.

Units are the different texts. All units of a bucket are compared with one of them, the
bucket's leader, and links give classes; so copies of one document cost one comparison each.
Where the other units of a bucket are still of several classes, all units of different
classes are compared, block by block inside the tasks: a bucket is dealt into blocks by a hash of
its units, every two blocks meet, and a task gives a spanning forest of the classes it found to be
linked, not the pairs. So no link that joins two classes of a bucket is missed.

Defined cases: null and empty texts, and texts without words, are near only to
equal texts; a null id is in no class and kept; rows of one id are one document, which is linked
with whatever one of its texts is linked with; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm import byte_words
from ordersight.llm.components import components
from ordersight.llm.tables import table
from ordersight.plans.shared_store import store

SHINGLE_WORDS = 5
SIMILAR = 0.8
BANDS, BAND_ROWS = 18, 4
SAMPLES = BANDS * BAND_ROWS
#: A shingle is listed as frequent from this share of the documents on.
FREQUENT = 1 / 200
#: Pairs that agree in fewer samples are no candidates: five standard deviations below SIMILAR.
LEAST_EQUAL = 40
#: Mean number of units, and mean bytes of their sets, that a block of a bucket holds at most.
BLOCK_UNITS, BLOCK_BYTES = 2048, 1 << 24
SKETCH_BITS = 19
SLICE = 1 << 14

_draw = np.random.Generator(np.random.PCG64(71))
_R = _draw.gamma(2.0, 1.0, 1 << 16)
_LN_C = np.log(_draw.gamma(2.0, 1.0, 1 << 16))
_BETA = _draw.random(1 << 16)
_SPREAD = _draw.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = _draw.integers(1, 2**63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sortable(values: np.ndarray) -> np.ndarray:
    """32-bit floats as integers of the same order."""
    bits = values.astype(np.float32).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000))


def _height(slot: np.ndarray, weight: np.ndarray | float) -> np.ndarray:
    r, beta = _R[slot], _BETA[slot]
    t = np.floor(np.log(weight) / r + beta)
    return _sortable(_LN_C[slot] - r * (t + 1 - beta))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text of a chunk: text, hash (ascending per text), count."""
    found = byte_words.words(data, offsets)
    hashes, owners = byte_words.shingles(found, SHINGLE_WORDS)
    for size in range(1, SHINGLE_WORDS):
        few = np.flatnonzero(found.counts == size)
        if len(few):
            short, owner = byte_words.shingles(found, size)
            mine = np.isin(owner, few)
            hashes, owners = np.append(hashes, short[mine]), np.append(owners, owner[mine])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    return owners[new], hashes[new], np.diff(np.append(new, len(hashes)))


class Weights:
    """Inverse document frequencies: those of the frequent shingles, and one for all others."""

    def __init__(self, frequent: pa.Table, documents: int):
        hashes = frequent["hash"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        counts = frequent["n"].to_numpy().astype(float)[order]
        self.values = np.log1p(documents / np.maximum(counts, 1))
        self.others = float(np.log1p(1 / FREQUENT))

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = np.full(len(hashes), self.others)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            weights[hit] = self.values[at[hit]]
        return weights * counts


def samples(owners: np.ndarray, hashes: np.ndarray, weights: np.ndarray, usual: float) -> tuple[np.ndarray, np.ndarray]:
    """Texts with shingles, and their samples (texts x SAMPLES); equal values are the same sample."""
    starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1])) if len(owners) else np.zeros(0, np.int64)
    kept = np.empty((len(starts), SAMPLES), np.uint64)
    if not len(starts):
        return owners, kept
    table_ = _height(np.arange(1 << 16), usual).astype(np.uint64) << np.uint64(32)
    low = hashes & np.uint64(0xFFFFFFFF)
    other = np.flatnonzero(weights != usual)
    for k in range(SAMPLES):
        slot = (hashes * _SPREAD[k]) >> np.uint64(48)
        key = table_[slot]
        if len(other):
            key[other] = _height(slot[other], weights[other]).astype(np.uint64) << np.uint64(32)
        key |= low
        kept[:, k] = np.minimum.reduceat(key, starts)
    return owners[starts], kept


def _frequent_shingles(texts: DataFrame, documents: int) -> pa.Table:
    """Document frequency of the shingles in at least ``FREQUENT`` of the documents."""
    spark = texts.sparkSession
    least = max(2, int(np.ceil(documents * FREQUENT)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, data, offsets in byte_words.chunks(batch.column("text")):
                hashes = shingle_sets(data, offsets)[1]
                counts += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        for at in range(0, len(counts), SLICE):
            if counts[at : at + SLICE].any():
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([counts[at : at + SLICE].astype("<i8").tobytes()])], ["slice", "counts"])

    def heavy(slices: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in slices:
            for at, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                total[at] = total.get(at, 0) + np.frombuffer(counts.as_py(), "<i8")
        for at, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(at + np.flatnonzero(counts >= least))], ["cell"])

    slices = texts.mapInArrow(sketch, "slice long, counts binary").repartition("slice")
    cells = np.zeros(1 << SKETCH_BITS, bool)
    cells[slices.mapInArrow(heavy, "cell long").toArrow()["cell"].to_numpy()] = True
    shared = spark.sparkContext.broadcast(cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            parts = [np.zeros(0, np.uint64)]
            for _, data, offsets in byte_words.chunks(batch.column("text")):
                hashes = shingle_sets(data, offsets)[1]
                parts.append(hashes[cells[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]])
            found, times = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], ["hash", "n"])

    counted = texts.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return counted.toArrow()


def _signatures(docs: DataFrame, weights) -> DataFrame:
    """doc, same (hash of the text), bands, signature (16 bits a sample), bytes of the set; no bands without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands: list = [None] * batch.num_rows
            signs: list = [None] * batch.num_rows
            sizes = np.zeros(batch.num_rows, np.int64)
            for first, data, offsets in byte_words.chunks(batch.column("text")):
                owners, hashes, counts = shingle_sets(data, offsets)
                sizes[first : first + len(offsets) - 1] = 8 * np.bincount(owners, minlength=len(offsets) - 1)
                rows, kept = samples(owners, hashes, weights.value.of(hashes, counts), weights.value.others)
                joined = np.zeros((len(rows), BANDS), np.uint64)
                for k in range(BAND_ROWS):
                    joined += kept[:, k::BAND_ROWS] * _JOIN[k]
                joined = byte_words.mix(joined + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                short = (byte_words.mix(kept) >> np.uint64(48)).astype("<u2")
                for row, band, sign_ in zip(rows.tolist(), joined, short):
                    bands[first + row], signs[first + row] = band, sign_.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("same"), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary()), pa.array(sizes)],
                ["doc", "same", "bands", "sign", "size"],
            )

    return docs.mapInArrow(sign, "doc long, same binary, bands array<long>, sign binary, size long")


def _weighted_sets(texts: DataFrame, weights) -> DataFrame:
    """unit and its set: 32 bits of each hash, ascending, and the weights."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, blobs = [], []
            units = np.asarray(batch.column("unit"))
            for first, data, offsets in byte_words.chunks(batch.column("text")):
                owners, hashes, counts = shingle_sets(data, offsets)
                values = weights.value.of(hashes, counts).astype("<f4")
                short = (hashes >> np.uint64(32)).astype("<u4")
                bounds = np.searchsorted(owners, np.arange(len(offsets)))
                for row, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    ids.append(units[first + row])
                    blobs.append(short[a:b].tobytes() + values[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["unit", "items"])

    return texts.select("unit", "text").mapInArrow(sets, "unit long, items binary")


def weighted_jaccard(one: bytes, other: bytes) -> float:
    (ids_a, w_a), (ids_b, w_b) = (
        (np.frombuffer(x, "<u4", len(x) // 8), np.frombuffer(x, "<f4", len(x) // 8, len(x) // 2).astype(float)) for x in (one, other)
    )
    if not len(ids_a) or not len(ids_b):
        return 0.0
    at = np.minimum(np.searchsorted(ids_b, ids_a), len(ids_b) - 1)
    hit = ids_b[at] == ids_a
    shared = np.minimum(w_a[hit], w_b[at[hit]]).sum()
    return float(shared / (w_a.sum() + w_b.sum() - shared))


def _likely(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs that agree in enough samples."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (np.frombuffer(b"".join(batch.column(n).to_pylist()), "<u2").reshape(-1, SAMPLES) for n in ("sign_a", "sign_b"))
            enough = pa.array((one == other).sum(1) >= LEAST_EQUAL)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(enough), batch.column("b").filter(enough)], ["a", "b"])

    for side in ("a", "b"):
        pairs = pairs.join(signs.select(F.col("unit").alias(side), F.col("sign").alias(f"sign_{side}")), side)
    return pairs.mapInArrow(agree, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = [weighted_jaccard(x.as_py(), y.as_py()) >= similar for x, y in zip(batch.column("items_a"), batch.column("items_b"))]
            mask = pa.array(close, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("unit").alias(side), F.col("items").alias(f"items_{side}")), side)
    return pairs.mapInArrow(verify, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group, which may go over several batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        groups = batch.column("group").to_numpy()
        edges = np.flatnonzero(groups[1:] != groups[:-1]) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(groups)]):
            if a == b:
                continue
            if held and groups[a] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = groups[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _forest(pair: pa.Table, similar: float) -> list[tuple[int, int]]:
    """Links that join the classes of two blocks (or one with itself); one for each two classes that become one."""
    units, classes = pair["unit"].to_numpy(), pair["class"].to_numpy().copy()
    first, second = (np.flatnonzero(pair[side].to_numpy()) for side in ("first", "second"))
    own = len(first) == len(second) == len(units)
    if (classes == classes[0]).all():
        return []
    signs = np.frombuffer(b"".join(pair["sign"].to_pylist()), "<u2").reshape(-1, SAMPLES)
    blobs = pair["items"].to_pylist()
    sizes = np.array([len(x) // 8 for x in blobs])
    starts = np.cumsum(sizes) - sizes
    shingles, places = np.unique(np.concatenate([np.frombuffer(x, "<u4", len(x) // 8) for x in blobs]), return_inverse=True)
    weights = np.concatenate([np.frombuffer(x, "<f4", len(x) // 8, len(x) // 2) for x in blobs]).astype(float)
    totals = np.add.reduceat(weights, starts)
    mine = np.zeros(len(shingles))
    links = []
    for i in first:
        others = second[second > i] if own else second
        others = others[classes[others] != classes[i]]
        others = others[(signs[others] == signs[i]).sum(1) >= LEAST_EQUAL]
        if not len(others):
            continue
        here = slice(starts[i], starts[i] + sizes[i])
        mine[places[here]] = weights[here]
        ends = np.cumsum(sizes[others])
        entries = np.arange(ends[-1]) + np.repeat(starts[others] - ends + sizes[others], sizes[others])
        shared = np.add.reduceat(np.minimum(mine[places[entries]], weights[entries]), ends - sizes[others])
        mine[places[here]] = 0
        for j in others[shared / (totals[i] + totals[others] - shared) >= similar]:
            if classes[j] != classes[i]:
                links.append((units[i], units[j]))
                classes[classes == classes[j]] = classes[i]
    return links


def _links_in_blocks(cells: DataFrame, signs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) that join the classes of each bucket of ``cells`` (bucket, unit, class, size)."""
    by_class = cells.groupBy("bucket", "class").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_UNITS), F.ceil(F.sum("bytes") / BLOCK_BYTES))
    several = by_class.groupBy("bucket").agg(F.count("*").alias("classes"), blocks.alias("blocks")).where("classes > 1")
    dealt = cells.join(several, "bucket").withColumn("block", F.pmod(F.xxhash64("unit"), F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    group = F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"))
    met = met.select("unit", "class", group.alias("group"), (F.col("block") <= F.col("other")).alias("first"), (F.col("block") >= F.col("other")).alias("second"))
    met = met.join(signs.select("unit", "sign"), "unit").join(sets, "unit")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in _groups(batches):
            links = _forest(pair, similar)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*links)], ["a", "b"])

    return met.repartition("group").sortWithinPartitions("group").mapInArrow(compare, "a long, b long").distinct()


def _links(buckets: DataFrame, signs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) of units that share a bucket; the classes they give are whole."""
    leaders = buckets.groupBy("bucket").agg(F.min("unit").alias("leader"))
    led = store(buckets.join(leaders, "bucket").where("unit != leader"))
    pairs = led.select(F.col("leader").alias("a"), F.col("unit").alias("b")).distinct()
    found = store(_verified(_likely(pairs, signs), sets, similar))
    classes = components(found)
    cells = led.join(classes, led.unit == classes.id, "left").select("bucket", "unit", F.coalesce("component", "unit").alias("class"), "size")
    return found.unionByName(store(_links_in_blocks(cells, signs, sets, similar)))


def near_duplicate_classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id): the smallest id of the documents it is linked with, directly or not."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"))
    known = known.withColumn("same", F.unhex(F.sha2("text", 256)))
    documents = known.count()
    weights = spark.sparkContext.broadcast(Weights(_frequent_shingles(known.select("text"), documents), documents))
    signed = _signatures(known.select("doc", "same", "text"), weights)
    # Rows of one text are alike in all but the id.
    distinct = signed.groupBy("same").agg(F.min("doc").alias("first"), *[F.any_value(c).alias(c) for c in ("bands", "sign", "size")])
    units = store(distinct.withColumn("unit", F.monotonically_increasing_id()))
    members = store(known.select("doc", "same").distinct().join(units.select("same", "unit", "first"), "same").select("doc", "unit", "first"))
    exploded = units.where("bands is not null").select("unit", "size", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = store(exploded.join(shared, "bucket"))
    candidates = buckets.select("unit").distinct()
    signs = units.select("unit", "sign").join(candidates, "unit", "left_semi")
    wanted = units.join(candidates, "unit", "left_semi").select("unit", F.col("first").alias("doc"), "same")
    texts = known.join(wanted.hint("shuffle_hash"), ["doc", "same"])
    sets = store(_weighted_sets(texts, weights).dropDuplicates(["unit"]))
    # An id that names several texts joins them.
    ids = members.groupBy("doc").agg(F.min("unit").alias("low"), F.max("unit").alias("high")).where("low < high")
    of_one_id = members.join(ids, "doc").where("unit != low").select(F.col("low").alias("a"), F.col("unit").alias("b")).distinct()
    classes = components(_links(buckets, signs, sets, similar).unionByName(of_one_id))
    named = classes.join(units.select(F.col("unit").alias("id"), "first"), "id")
    least = classes.join(named.groupBy("component").agg(F.min("first").alias("least")), "component").select("id", "least")
    joined = members.join(least, members.unit == least.id, "left")
    return joined.select(F.col("doc").alias("doc_id"), F.coalesce("least", "first").alias("class_id")).distinct()


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    classes = near_duplicate_classes(docs).withColumnRenamed("doc_id", "id")
    joined = docs.select("doc_id").join(classes, F.col("doc_id").cast("long") == F.col("id"), "left")
    return joined.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
