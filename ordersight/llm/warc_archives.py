"""WARC archives of captured pages: records as gzip members, written and read by byte ranges.

Files are real ``.warc.gz`` archives in a folder that all executors share, reached by pyarrow's
file systems (local or mounted folders, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem

#: Record formats.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Capture time written into records; pages carry none.
CAPTURED = "2024-01-01T00:00:00Z"
#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Ranges of an archive that lie this near are read at once, up to so many bytes.
READ_GAP, READ_BYTES = 64 << 10, 4 << 20
_GZIP = 31
_ODD = re.compile(r"[\x00-\x20\x7f]")


def open_folder(uri: str) -> tuple[FileSystem, str]:
    """The file system of a folder and the folder's path in it; s3a and s3n mean S3."""
    return FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


@dataclass
class Record:
    """One record as read back: its headers, and the payload it holds (none for a revisit)."""

    headers: dict[str, str]
    payload: bytes

    @property
    def kind(self) -> str:
        return self.headers["WARC-Type"]

    @property
    def digest(self) -> str:
        return self.headers["WARC-Payload-Digest"].removeprefix("sha256:")

    @property
    def full_bytes(self) -> int:
        """Length of the full payload, which a revisit states in the HTTP headers it kept."""
        return int(self.headers["http:Content-Length"])

    def page(self, header: str) -> int | None:
        """The page id that a record id of this library names."""
        found = self.headers.get(header, "")
        return int(found[len("<urn:page:") : -1]) if found.startswith("<urn:page:") else None


def _clean(url: str) -> str:
    """A header value cannot hold spaces or control characters: they are percent-encoded."""
    return _ODD.sub(lambda found: f"%{ord(found[0]):02X}", url)


def compose(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record as one gzip member; a ``refers_to`` makes it a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    own = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.UUID(digest[:32])}>"
    headers = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {own}", f"WARC-Date: {CAPTURED}"]
    if url is not None:
        headers.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        headers += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    headers += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(5, zlib.DEFLATED, _GZIP)
    return packer.compress("\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> Record:
    """The record in a gzip member; a length or digest that does not hold is an error."""
    data = zlib.decompress(member, _GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    headers |= {f"http:{k}": v for k, v in (line.split(": ", 1) for line in http.decode().split("\r\n")[1:])}
    record = Record(headers, payload)
    if record.kind == "response" and (hashlib.sha256(payload).hexdigest() != record.digest or len(payload) != record.full_bytes):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not have its digest")
    return record


class ArchiveWriter:
    """Writes records into numbered archives of one task attempt.

    Files carry a random name of the attempt. A lost or repeated attempt leaves files that no
    index names; they go with the folder.
    """

    def __init__(self, folder: str, archive_bytes: int = ARCHIVE_BYTES):
        self.files, self.folder = open_folder(folder)
        self.files.create_dir(self.folder, recursive=True)
        self.attempt, self.number, self.limit = uuid.uuid4().hex, 0, archive_bytes
        self.out, self.offset, self.name = None, 0, ""

    def add(self, member: bytes) -> tuple[str, int, int]:
        """(archive, offset, length) of the record."""
        if self.out is not None and self.offset + len(member) > self.limit:
            self.close()
        if self.out is None:
            self.name, self.offset = f"pages-{self.attempt}-{self.number:05d}.warc.gz", 0
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.number += 1
        at = self.offset
        self.out.write(member)
        self.offset += len(member)
        return self.name, at, len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class ArchiveReader:
    """Reads byte ranges of archives; neighbouring ranges are fetched together."""

    def __init__(self, folder: str):
        self.files, self.folder = open_folder(folder)
        self.name, self.file = None, None

    def _fetch(self, name: str, start: int, end: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.files.open_input_file(f"{self.folder}/{name}")
        return self.file.read_at(end - start, start)

    def members(self, ranges: list[tuple[str, int, int]]) -> Iterator[bytes]:
        """The bytes of each (archive, offset, length), in order; best sorted by both."""
        at = 0
        while at < len(ranges):
            name, start, length = ranges[at]
            end, last = start + length, at + 1
            while last < len(ranges) and ranges[last][0] == name:
                _, begin, more = ranges[last]
                if not (start <= begin <= end + READ_GAP and begin + more - start <= READ_BYTES):
                    break
                end, last = max(end, begin + more), last + 1
            data = self._fetch(name, start, end)
            for _, begin, more in ranges[at:last]:
                yield data[begin - start : begin - start + more]
            at = last

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.name, self.file = None, None


def write_records(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """page_id, url, payload, digest, refers_to -> page_id, url, archive, offset, length."""
    writer = ArchiveWriter(folder, archive_bytes)
    for batch in batches:
        places = []
        columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
        for at in range(len(batch)):
            page_id, url, payload, digest, refers_to = (c[at].as_py() for c in columns)
            places.append(writer.add(compose(page_id, url, payload, digest, refers_to)))
        names, offsets, lengths = zip(*places) if places else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
            ["page_id", "url", "archive", "offset", "length"],
        )
    writer.close()


def read_records(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    """archive, offset, length -> the record's page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload)."""
    reader = ArchiveReader(folder)
    for batch in batches:
        ranges = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
        rows, held = [], 0
        for member in reader.members(ranges):
            record = parse(member)
            row = (record.page("WARC-Record-ID"), record.headers.get("WARC-Target-URI"), record.full_bytes, record.digest, record.kind, record.page("WARC-Refers-To"))
            rows.append((*row, record.payload) if with_payload else row)
            held += len(record.payload) if with_payload else 0
            if held > READ_BYTES:
                yield _rows(rows, with_payload)
                rows, held = [], 0
        yield _rows(rows, with_payload)
    reader.close()


RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _rows(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    kinds += [("payload", pa.binary())] if with_payload else []
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(columns, kinds)], [name for name, _ in kinds])
