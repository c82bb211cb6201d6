"""A two-level index of WARC captures, and pages by way of their archives (op12).

``write_pages`` writes each page as a WARC record: of pages with equal payloads of at least
``LEAST_BYTES`` bytes, the one with the smallest page_id is a response and the others revisit it.
``build_index`` sorts the captures of all archives by reversed-host key and page over the
cluster and writes them as compressed blocks; the directory holds the first key of each block.
``locate`` finds captures for any number of requests: a binary search of the directory names
the blocks, each block is opened once for all its requests and searched in the same way.
``read_captures`` then reads byte ranges of the archives.

Results for odd rows: a null html is an empty payload, a null url has the key '' and no target in
its record, a null page_id is larger than all others and never revisited. Rows that share the
smallest page_id of their payload are all responses; a repeated row has a record for each copy.
Spaces and control characters of a url are percent-encoded in the record. An empty table gives
no archives, blocks or rows. Other columns are ignored. A page is held whole by one task.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm.tables import partitions_for, ship_library, table
from ordersight.llm.warc_archives import ARCHIVE_BYTES, RECORD_SCHEMA, read_records, write_records
from ordersight.plans.shared_store import run_folder, store

#: Payloads of fewer bytes are never revisited.
LEAST_BYTES = 100
#: Captures of a block, and blocks at most: with more captures the blocks grow, so that the
#: directory stays within what a broadcast may hold (keys in it are cut to ``KEY_BYTES``).
BLOCK_CAPTURES, MOST_BLOCKS, KEY_BYTES = 3000, 100_000, 200
#: Repeated payloads known to every task; beyond it they meet the pages in a shuffle.
MOST_BROADCAST = 500_000
#: Bytes of archives that a task reads.
TASK_BYTES = 16 << 20
_PORT = {"http": 80, "https": 443}


def url_key(url: str | None) -> str:
    """The key urls are sorted by: host reversed and lower-cased, then path and query.

    ``https://www.Example.org:443/a?b`` is ``org,example,www)/a?b``. What is no url with
    a host is its own key.
    """
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    port = f":{port}" if port and port != _PORT.get(parts.scheme) else ""
    name = host if re.fullmatch(r"[0-9.]+", host) or ":" in host else ",".join(reversed(host.split(".")))
    return f"{name}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _ordered(key: str, page_id: int | None) -> tuple[bytes, bool, int]:
    """What captures are sorted by, as Spark sorts (key, page_id): bytes, null ids last."""
    return key.encode(), page_id is None, page_id or 0


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, *(batch.column(c) for c in batch.schema.names if c != "url")], ["key", *(c for c in batch.schema.names if c != "url")])


def page_columns(pages: DataFrame) -> DataFrame:
    """page_id, url and html of any table with these columns, typed."""
    return pages.select(*[pages[f"`{c}`"].cast(kind).alias(c) for c, kind in (("page_id", "long"), ("url", "string"), ("html", "string"))])


def write_pages(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Write a record per page into archives below ``folder``; page_id, key, archive, offset, length of each."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = page_columns(pages).select("page_id", "url", payload.alias("payload"))
    records = records.withColumn("digest", F.sha2("payload", 256)).withColumn("long", F.octet_length("payload") >= LEAST_BYTES)
    first = records.where("long").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = store(first.where("n > 1 and first is not null").select(F.col("digest").alias("same"), "first"))
    # Digest and id: 40 bytes each. More of them than a broadcast may hold meet the pages in a shuffle.
    if repeated.count() <= most_broadcast:
        repeated = F.broadcast(repeated)
    found = records.join(repeated, F.col("long") & (F.col("digest") == F.col("same")), "left")
    refers_to = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    written = found.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to")).mapInArrow(
        partial(write_records, folder=folder, archive_bytes=archive_bytes), "page_id long, url string, archive string, offset long, length long"
    )
    # Stored before anything reads it: what a second run of a task would write has other names.
    written = store(written)
    return written.select("url", "page_id", "archive", "offset", "length").mapInArrow(_keys, "key string, page_id long, archive string, offset long, length long")


class _Blocks:
    """Cuts the sorted captures of a task into compressed blocks."""

    def __init__(self, captures_each: int):
        self.each = captures_each

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "archive", "offset", "length")))
            while len(held) >= self.each:
                yield self.block(held[: self.each])
                held = held[self.each :]
        if held:
            yield self.block(held)

    @staticmethod
    def block(rows: list[tuple]) -> pa.RecordBatch:
        data = zlib.compress("\n".join(json.dumps(row, ensure_ascii=False) for row in rows).encode(), 6)
        (key, page_id), (last, last_id) = rows[0][:2], rows[-1][:2]
        values = [[uuid.uuid4().hex], [key], [page_id], [last], [last_id], [len(rows)], [data]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))], _BLOCK_COLUMNS)


_BLOCK_COLUMNS = ["block", "first_key", "first_id", "last_key", "last_id", "n", "data"]


@dataclass
class CaptureIndex:
    """Sorted compressed blocks of captures (a stored table), and where their archives are."""

    blocks: DataFrame
    folder: str

    def directory(self) -> dict[str, list]:
        """The first key of every block, in order: at most about ``MOST_BLOCKS`` rows of a few hundred bytes."""
        rows = self.blocks.select("block", "first_key", "first_id", "last_key", "last_id").collect()
        rows.sort(key=lambda r: (*_ordered(r.first_key, r.first_id), *_ordered(r.last_key, r.last_id)))
        # A long key is cut: a cut first key is lower and a cut last key is raised, so no block is passed over.
        first = [_cut(r.first_key, r.first_id, False) for r in rows]
        last = [_cut(r.last_key, r.last_id, True) for r in rows]
        return {"blocks": [r.block for r in rows], "first": first, "last": last}


def _cut(key: str, page_id: int | None, up: bool) -> tuple[bytes, bool, int]:
    data = key.encode()
    if len(data) < KEY_BYTES:
        return _ordered(key, page_id)
    return (data[:KEY_BYTES] + b"\xff", True, 0) if up else (data[:KEY_BYTES], False, -(2**63))


def build_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> CaptureIndex:
    """Sort the captures over the cluster and store them in blocks."""
    captures = store(captures)
    count = captures.count()
    each = max(block_captures, -(-count // MOST_BLOCKS))
    order = ["key", F.asc_nulls_last("page_id"), "archive", "offset"]
    # A page's copies are spread by place, so one url with a third of all captures fills many tasks.
    tasks = max(1, min(count // (4 * each), 10_000))
    ordered = captures.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    blocks = ordered.mapInArrow(_Blocks(each), "block string, first_key string, first_id long, last_key string, last_id long, n long, data binary")
    return CaptureIndex(store(blocks), folder)


class _Search:
    """Names the blocks that may hold a request, by binary search of the directory."""

    def __init__(self, held):
        self.held = held

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = self.held.value
        names, first, last = directory["blocks"], directory["first"], directory["last"]
        for batch in batches:
            at, blocks = [], []
            keys = [_ordered(k, p) for k, p in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist())]
            for row, wanted in enumerate(keys):
                for block in range(bisect_left(last, wanted), bisect_right(first, wanted)):
                    at.append(row)
                    blocks.append(names[block])
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.string()), taken.column("key"), taken.column("page_id")], ["block", "key", "page_id"])


def _open_blocks(requests: pa.Table, blocks: pa.Table) -> pa.Table:
    """The captures of one block that requests name, found by binary search."""
    found: list[tuple] = []
    for data in blocks.column("data").to_pylist():
        rows = [json.loads(line) for line in zlib.decompress(data).decode().split("\n")]
        order = [_ordered(row[0], row[1]) for row in rows]
        for key, page_id in zip(requests.column("key").to_pylist(), requests.column("page_id").to_pylist()):
            wanted = _ordered(key, page_id)
            found += (rows[at][2:] for at in range(bisect_left(order, wanted), bisect_right(order, wanted)))
    names, offsets, lengths = zip(*found) if found else ((), (), ())
    return pa.table({"archive": pa.array(names, pa.string()), "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64())})


def locate(index: CaptureIndex, requests: DataFrame) -> DataFrame:
    """archive, offset, length of all captures of the requests (url, page_id); a request asked twice counts once."""
    held = requests.sparkSession.sparkContext.broadcast(index.directory())
    keyed = requests.select("url", "page_id").mapInArrow(_keys, "key string, page_id long").distinct()
    wanted = keyed.mapInArrow(_Search(held), "block string, key string, page_id long")
    blocks = index.blocks.select("block", "data")
    return wanted.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_open_blocks, "archive string, offset long, length long")


def read_captures(index: CaptureIndex, places: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records at archive, offset, length, read as byte ranges in the order they lie in."""
    places = store(places)
    # Tasks by the bytes they read: the ranges themselves are small rows, which Spark would put together.
    amount = places.agg(F.sum("length")).first()[0] or 0
    tasks = partitions_for(amount, TASK_BYTES, 1)
    ordered = places.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    return ordered.mapInArrow(partial(read_records, folder=index.folder, with_payload=with_payload), schema)


def archive_pages(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, block_captures: int = BLOCK_CAPTURES) -> CaptureIndex:
    """Write all pages below ``folder`` and index them."""
    return build_index(write_pages(pages, folder, archive_bytes), folder, block_captures)


def op12_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_library(spark)
    pages = table(spark, sf_dir, "pages")
    index = archive_pages(pages, f"{run_folder(spark)}/warc-{uuid.uuid4().hex}")
    # Every page is asked for by its url and id, and read back from its archive.
    found = read_captures(index, locate(index, page_columns(pages).select("url", "page_id")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
WITH records AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM records WHERE n >= 100 GROUP BY payload)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM records LEFT JOIN firsts USING (payload)
"""
