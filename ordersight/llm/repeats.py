"""Suffix-array deduplication: remove bytes of strings that start in an earlier document.

Every window of 50 bytes belongs to the smallest hash of its 31 strings of 20
bytes, which depends on the window's bytes alone, so equal windows belong to the
same hash wherever they are. A run of windows with one hash is a segment. Segments meet by
that hash, in three steps:

1. Equal segments (same hash and content) need no text: all but those of the
   smallest document are removed. Copies that meet in one batch are settled
   there, so a passage of very many documents sends one entry a batch.
2. A hash with several different segments is settled on bytes. The segments of
   a bucket of hashes are one string; its Burrows-Wheeler transform is refined
   by breadth-first backward extension: after step k two neighbours in suffix
   order are apart if their common prefix is below k. It stops at 50, and what is
   still together are equal 50-byte strings.
3. A hash with very many different segments (a frequent line in many contexts)
   is first cut into its windows. These meet like segments, by their own content, so
   equal ones are settled where they meet and no bucket gathers the others.

Documents meet their removed ranges by id. No text is gathered by key other than
by its own id.

Defined cases: null and empty texts have no bytes and nothing to remove; a text
under 50 bytes is kept whole; of rows with the same id each is judged by that id, so
they never remove from one another; rows with a null id, or whose id also names
another text, are returned whole and remove nothing from others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.llm import byte_words
from ordersight.llm.tables import as_rows, partitions_for, table, text_bytes
from ordersight.plans.shared_store import store

WINDOW = 50
GRAM = 20
#: Bytes of text whose segments make one bucket.
BUCKET_BYTES = 8 << 20
#: Different segments of one hash beyond which they are cut into windows.
CROWD = 500
#: Bytes of segments refined at once (hashes are kept whole).
BLOCK_BYTES = 1 << 18
#: What a task holds at once: bytes of text, or windows of a crowd, that are settled among themselves
#: (any such unit is at least one chunk), bytes of entries in a batch, documents of which the rest is joined.
UNIT_BYTES = 6 << 20
UNIT_WINDOWS = 1 << 18
BATCH_BYTES = 2 << 20
CUT_DOCS = 500

_FOUND = "kind int, doc long, ranges binary, starts binary, windows binary"
_ENTRIES = "bucket int, gram binary, content binary, doc binary, start binary, windows binary"


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one smallest hash: text, first byte, windows, hash, content hash."""
    spread = WINDOW - GRAM + 1
    if len(data) < WINDOW:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    ranges = byte_words.RangeHash(data, lower=False)
    least = byte_words.mix(ranges.every(GRAM))
    width = 1
    while width * 2 <= spread:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < spread:
        least = np.minimum(least[: len(least) - (spread - width)], least[spread - width :])
    usable = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    # Windows across the border of two texts do not count.
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, offsets[:-1][usable > 0], 1)
    np.add.at(inside, (offsets[:-1] + usable)[usable > 0], -1)
    valid = np.cumsum(inside)[: len(least)] > 0
    starts = valid.copy()
    starts[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    first = offsets[:-1][usable > 0]
    starts[first] = True
    starts = np.flatnonzero(starts)
    owners = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), (offsets[:-1] + usable)[owners])
    content = byte_words.mix(ranges.of(starts, ends + WINDOW - 1))
    return owners, starts - offsets[owners], ends - starts, least[starts], content


_KINDS = ("<u4", "<u8", "<i8", "<u4", "<u4")
_NAMES = ("gram", "content", "doc", "start", "windows")


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Byte planes of an array: equal high bytes stand together and compress well."""
    flat = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1)
    return flat.T.tobytes()


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def _settle(gram, content, doc, start, windows):
    """Split entries into (those of the smallest document per segment), (others); the first sorted by hash and content."""
    order = np.lexsort((content, gram))
    gram, content, doc, start, windows = (x[order] for x in (gram, content, doc, start, windows))
    if not len(gram):
        return [gram, content, doc, start, windows], [doc, start, windows]
    new = np.append(True, (gram[1:] != gram[:-1]) | (content[1:] != content[:-1]))
    least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
    kept = doc == least
    return [x[kept] for x in (gram, content, doc, start, windows)], [x[~kept] for x in (doc, start, windows)]


def _removed_batch(doc, start, end) -> pa.RecordBatch:
    """One row per document: its removed ranges, joined where they touch."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    ids, first = np.unique(doc, return_index=True)
    blobs = []
    for at, past in zip(first, np.append(first[1:], len(doc))):
        s, e = merge_ranges(start[at:past], end[at:past])
        blobs.append(np.concatenate([s, e]).astype("<u4").tobytes())
    none = pa.nulls(len(ids))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), -1, np.int32)), pa.array(ids), pa.array(blobs, pa.binary()), none.cast(pa.binary()), none.cast(pa.binary())],
        ["kind", "doc", "ranges", "starts", "windows"],
    )


def merge_ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges sorted by start; overlapping and touching ones become one."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at[1:] - 1, len(start) - 1)]


def _packed_entries(spread, content, doc, start, windows, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of a batch by bucket, after those that meet here are settled.

    The bucket and 32 more bits of the hash, and 48 bits of the content's hash, tell segments apart.
    """
    place = (spread >> np.uint64(32)) % np.uint64(buckets)
    gram = (spread & np.uint64(0xFFFFFFFF)) | (place << np.uint64(32))
    kept, (doc, start, windows) = _settle(gram, content >> np.uint64(16), doc, start, windows)
    rows = []
    bounds = np.searchsorted(kept[0] >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(bounds)):
        mine = bounds[bucket] + np.argsort(kept[2][bounds[bucket] : bounds[bucket + 1]], kind="stable")
        rows.append((int(bucket), *(_pack(x[mine], kind) for x, kind in zip(kept, _KINDS))))
    if len(doc):
        # Settled here: dealt by document instead, as ranges to remove.
        home = doc % buckets
        order = np.argsort(home, kind="stable")
        bounds = np.searchsorted(home[order], np.arange(buckets + 1))
        for bucket in np.flatnonzero(np.diff(bounds)):
            mine = order[bounds[bucket] : bounds[bucket + 1]]
            rows.append((int(bucket), None, None, *(_pack(x[mine], kind) for x, kind in zip((doc, start, windows), _KINDS[2:]))))
    some, size = [], 0
    for at, row in enumerate(rows):
        some.append(row)
        size += sum(len(x) for x in row[1:] if x is not None)
        if size >= BATCH_BYTES or at == len(rows) - 1:
            columns = list(zip(*some))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["bucket", *_NAMES])
            some, size = [], 0


def _entries(docs: DataFrame, buckets: int) -> DataFrame:
    """Segments of all documents, packed by bucket of their hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            ids = np.asarray(batch.column("doc_id"))
            for first, data, offsets in byte_words.chunks(batch.column("text")):
                # A batch may hold very many bytes, and its segments several times as many.
                if parts and size + len(data) > UNIT_BYTES:
                    yield from settled(parts)
                    parts, size = [], 0
                owners, start, windows, gram, content = segments(data, offsets)
                parts.append((gram, content, ids[first + owners], start, windows))
                size += len(data)
            if parts:
                yield from settled(parts)

    def settled(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        gram, content, doc, start, windows = (np.concatenate(x) for x in zip(*parts))
        yield from _packed_entries(byte_words.mix(gram), content, doc, start, windows, buckets)

    return docs.select("doc_id", "text").mapInArrow(cut, _ENTRIES)


def _compare_bucket(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    local = [[_unpack(x, kind) for x, kind in zip(row[2:], _KINDS[2:])] for row in held if row[0] is None]
    shared = [[_unpack(x, kind) for x, kind in zip(row, _KINDS)] for row in held if row[0] is not None]
    columns = [np.concatenate(x) for x in zip(*shared)] if shared else [np.zeros(0, kind) for kind in _KINDS]
    (gram, content, doc, start, windows), equal = _settle(*columns)
    gone, at, width = (np.concatenate(x) for x in zip(*local, equal))
    if len(gone):
        at = at.astype(np.int64)
        yield _removed_batch(gone, at, at + width + WINDOW - 1)
    if not len(gram):
        return
    # Hashes with one segment are done; the others need their bytes.
    new_gram = np.append(True, gram[1:] != gram[:-1])
    group = np.cumsum(new_gram) - 1
    new_content = np.append(True, content[1:] != content[:-1]) | new_gram
    different = np.bincount(group, new_content).astype(np.int64)
    firsts = np.minimum.reduceat(doc, np.flatnonzero(new_gram))
    lasts = np.maximum.reduceat(doc, np.flatnonzero(new_gram))
    crowd = (different > CROWD)[group]
    for kind, chosen in ((0, ~crowd), (1, crowd)):
        unsettled = np.flatnonzero((different > 1)[group] & (firsts < lasts)[group] & chosen)
        unsettled = unsettled[np.argsort(doc[unsettled], kind="stable")]
        ids, first = np.unique(doc[unsettled], return_index=True)
        pieces = [unsettled[a:b] for a, b in zip(first, np.append(first[1:], len(unsettled)))]
        if len(ids):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), kind, np.int32)),
                    pa.array(ids),
                    *(pa.array([x[p].astype(t).tobytes() for p in pieces], pa.binary()) for x, t in ((gram, "<u8"), (start, "<u4"), (windows, "<u4"))),
                ],
                ["kind", "doc", "ranges", "starts", "windows"],
            )


def _compare(entries: DataFrame) -> DataFrame:
    """Per bucket: ranges to remove (kind -1), and segments to settle on bytes (kind 0, or 1 in a crowd)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None
        for batch in batches:
            rows = zip(batch.column("bucket").to_pylist(), *(batch.column(n) for n in _NAMES))
            for bucket, *packed in rows:
                if bucket != current and held:
                    yield from _compare_bucket(held)
                    held = []
                current = bucket
                held.append(tuple(x.as_py() for x in packed))
        if held:
            yield from _compare_bucket(held)

    return entries.mapInArrow(gather, _FOUND)


def _sorted_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (first, second), both below 2**21 for short strings; and where the pair changes."""
    n = len(first)
    if n < 1 << 20:
        packed = (first.astype(np.uint64) << np.uint64(42)) | (second.astype(np.uint64) << np.uint64(21)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        key = packed >> np.uint64(21)
        order = (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
    else:
        order = np.lexsort((second, first))
        key = first[order] * (n + 1) + second[order]
    return order, np.append(True, key[1:] != key[:-1])


def bwt_groups(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a string and, along it, the group with a common prefix of ``length``.

    ``symbols`` are ranks from 0; separators must differ from each other and end the string.
    The order comes from prefix doubling. Then all strings are extended backward
    breadth first: place j of the order holds the symbol of the transform that
    stood at ``source[j]``, so it stays with place j - 1 in step k only if the sources
    were together in step k - 1.
    """
    n = len(symbols)
    order, apart = _sorted_pairs(np.unique(symbols, return_inverse=True)[1], np.zeros(n, np.int64))
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(apart) - 1
    step, new = 1, apart
    while rank[order[-1]] < n - 1:
        follow = np.zeros(n, np.int64)
        follow[:-step] = rank[step:] + 1
        order, new = _sorted_pairs(rank, follow)
        rank[order] = np.cumsum(new) - 1
        step *= 2
    transform = symbols[order - 1]
    source = np.argsort(transform, kind="stable").astype(np.int32)
    together = np.flatnonzero(~apart).astype(np.int32)
    here, before = source[together], source[together - 1]
    for _ in range(1, length):
        group = np.cumsum(apart, dtype=np.int32)
        cut = group[here] != group[before]
        apart[together[cut]] = True
        together, here, before = together[~cut], here[~cut], before[~cut]
        if not len(together):
            break
    return order, np.cumsum(apart) - 1


def smaller_elsewhere(texts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each text: which of its windows also are in a text of a smaller document."""
    sizes = np.array([len(t) for t in texts]) + 1
    text = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    ends = np.cumsum(sizes) - 1
    symbols = text.astype(np.int64) + len(texts)
    symbols[ends] = np.arange(len(texts))
    order, group = bwt_groups(symbols, WINDOW)
    owner = np.repeat(np.arange(len(texts)), sizes)[order]
    doc = docs[owner]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.minimum.reduceat(doc, starts)[group]
    hit = np.zeros(len(text), bool)
    hit[order] = doc > least
    firsts = ends + 1 - sizes
    return [hit[f : f + max(size - WINDOW, 0)] for f, size in zip(firsts, sizes)]


_PIECES = "bucket long, doc long, start int, piece binary"


def _parts_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(hash, document, first byte, windows, text) of the segments to settle."""
    for doc, parts, text in zip(batch.column("doc").to_pylist(), batch.column("parts").to_pylist(), batch.column("text")):
        text = text.as_py().encode()
        for part in parts:
            columns = (np.frombuffer(part[n], t).tolist() for n, t in (("ranges", "<i8"), ("starts", "<u4"), ("windows", "<u4")))
            for gram, start, count in zip(*columns):
                yield gram, doc, start, count, text


def _pieces(joined: DataFrame) -> DataFrame:
    """The bytes of the segments to settle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                rows = [(gram, doc, start, text[start : start + count + WINDOW - 1]) for gram, doc, start, count, text in _parts_of(batch.slice(at, 100))]
                columns = list(zip(*rows)) or [[]] * 4
                types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "doc", "start", "piece"])

    return joined.mapInArrow(cut, _PIECES)


def _crowd_entries(joined: DataFrame, buckets: int) -> DataFrame:
    """Each window of crowded segments as an entry of its own, dealt by its content."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, doc, start = [], [], []
            for _, owner, first, count, text in _parts_of(batch):
                for at in range(first, first + count):
                    digests.append(hashlib.blake2b(text[at : at + WINDOW], digest_size=16).digest())
                    doc.append(owner)
                    start.append(at)
                    if len(doc) >= UNIT_WINDOWS:
                        yield from settled(digests, doc, start)
                        digests, doc, start = [], [], []
            if doc:
                yield from settled(digests, doc, start)

    def settled(digests: list[bytes], doc: list[int], start: list[int]) -> Iterator[pa.RecordBatch]:
        spread, content = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2).T
        yield from _packed_entries(spread, content, np.array(doc, np.int64), np.array(start, np.uint32), np.ones(len(doc), np.uint32), buckets)

    return joined.mapInArrow(cut, _ENTRIES)


def _settle_on_bytes(pieces: DataFrame) -> DataFrame:
    """Repeated windows of segments; those of a hash stand together, a block of hashes is one string."""

    def block(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc = np.array([row[1] for row in held], np.int64)
        hits = smaller_elsewhere([row[3] for row in held], doc)
        gone = [np.full(int(h.sum()), row[1], np.int64) for row, h in zip(held, hits)]
        at = np.concatenate([row[2] + np.flatnonzero(h) for row, h in zip(held, hits)])
        if len(at):
            yield _removed_batch(np.concatenate(gone), at, at + WINDOW)

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("bucket", "doc", "start", "piece"))):
                if size > BLOCK_BYTES and row[0] != held[-1][0]:
                    yield from block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield from block(held)

    return pieces.mapInArrow(refine, _FOUND)


def _key() -> Column:
    return F.col("row.doc_id").cast("long")


def _ranges(rows: DataFrame) -> DataFrame:
    """(doc, ranges): packed byte ranges to remove; a document may have several rows."""
    spark = rows.sparkSession
    known = rows.select(_key().alias("doc_id"), "row.text")
    total = known.agg(F.coalesce(F.sum(text_bytes(F.col("text"))), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions_for(total, BUCKET_BYTES, 4 * parts)
    entries = _entries(known, buckets).repartition(partitions_for(buckets, 4, parts), "bucket")
    found = store(_compare(entries.sortWithinPartitions("bucket")))
    # One row a document, so that its text is handed on once.
    parts_of = F.collect_list(F.struct("ranges", "starts", "windows")).alias("parts")

    def with_text(kind: int) -> DataFrame:
        unsettled = found.where(F.col("kind") == kind).groupBy("doc").agg(parts_of).hint("shuffle_hash")
        return rows.join(unsettled, _key() == F.col("doc")).select("doc", "parts", F.col("row.text").alias("text"))

    tasks = partitions_for(buckets, 4, parts)
    plain = _pieces(with_text(0)).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    crowd = _crowd_entries(with_text(1), parts).repartition(parts, "bucket").sortWithinPartitions("bucket")
    ranges = [part.where("kind < 0").select("doc", "ranges") for part in (found, _settle_on_bytes(plain), _compare(crowd))]
    return ranges[0].unionByName(ranges[1]).unionByName(ranges[2])


_CUT = "n_bytes long, n_removed long, n_spans long"


def _cut(joined: DataFrame, as_text: bool) -> DataFrame:
    kept_type = T.StringType() if as_text else T.BinaryType()
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL(_CUT).fields, T.StructField("kept", kept_type)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, CUT_DOCS) for whole in batches for at in range(0, whole.num_rows, CUT_DOCS)):
            texts = pc.struct_field(batch.column("row"), "text").cast(pa.binary())
            facts = []
            for text, blobs in zip(texts, batch.column("ranges").to_pylist()):
                data = text.as_py() or b""
                starts, ends = _union(blobs or [])
                bounds = np.column_stack([np.append(0, ends), np.append(starts, len(data))]).tolist()
                if as_text:
                    # Characters cut in two go whole.
                    kept = "".join(data[a:b].decode("utf-8", "ignore") for a, b in bounds)
                else:
                    kept = b"".join(data[a:b] for a, b in bounds)
                facts.append((len(data), int((ends - starts).sum()), len(starts), kept))
            columns = list(zip(*facts)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string() if as_text else pa.binary())],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(cut, schema)


def _union(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if not blobs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = [np.frombuffer(blob, "<u4").astype(np.int64).reshape(2, -1) for blob in blobs]
    both = np.concatenate(parts, axis=1)
    return merge_ranges(*both[:, np.argsort(both[0], kind="stable")])


def remove_repeats(docs: DataFrame, *columns: str, as_text: bool = False) -> DataFrame:
    """``row`` (the named columns, with ``doc_id`` and ``text``), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``.

    ``kept`` are the remaining bytes; with ``as_text`` a string, without characters of which a byte is removed.
    """
    rows = as_rows(docs, *columns)
    shapes = rows.groupBy(_key().alias("doc")).agg((F.min(F.xxhash64("row.text")) != F.max(F.xxhash64("row.text"))).alias("unclear"))
    unclear = shapes.where("doc is not null and unclear").select("doc")
    whole = rows.where(_key().isNull())
    rows = rows.where(_key().isNotNull())
    if not unclear.isEmpty():
        whole = whole.unionByName(rows.join(unclear, _key() == F.col("doc"), "left_semi"))
        rows = rows.join(unclear, _key() == F.col("doc"), "left_anti")
    ranges = _ranges(rows).groupBy("doc").agg(F.collect_list("ranges").alias("ranges"))
    # The same exchange of the documents by id serves the join in _ranges and this one.
    joined = rows.join(ranges.hint("shuffle_hash"), _key() == F.col("doc"), "left").select("row", "ranges")
    return _cut(joined.unionByName(whole.withColumn("ranges", F.lit(None).cast("array<binary>"))), as_text)


def op4_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(table(spark, folder, "documents"), "doc_id", "text")
    return cut.select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
