from __future__ import annotations

import gzip
import hashlib
import os
import random

import pytest

from ordersight.llm import capture_index as op
from ordersight.llm.warc_archives import compose, parse

CLASHING = ["key", "digest", "payload", "first", "same", "archive", "offset", "length", "block", "long", "n"]


def make(spark, rows):
    schema = "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 100:
            first[data] = min(page_id, first.get(data, page_id))
    result = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == page_id else refers
        result.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(result, key=str)


def pages():
    draw = random.Random(5)
    long = "<html>" + "".join(draw.choice("abcdefgh é日\r\n") for _ in range(500_000)) + "</html>"
    rows = [(i, f"https://h{i % 9}.example.org/p/{i}?q={i}", f"<p>{'word ' * (i % 60)}</p>") for i in range(300)]
    rows += [(400 + i, "http://hot.example.org/", "x" * 200) for i in range(120)]
    rows += [(600, None, None), (601, "", ""), (602, "no url at all", long), (603, "http://a b\r\nX: y/ü", long), (None, "http://n.org/", long), (None, None, None)]
    rows += [(700, "http://same.org/", "y" * 150)] * 40 + [(701, "http://" + "l" * 900 + ".org/" + "p" * 900, "z" * 99)] * 2
    return rows


def read(index, requests):
    found = op.read_captures(index, op.locate(index, requests))
    return sorted((tuple(r) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize(("archive_bytes", "block_captures", "most"), [(64 << 20, 3000, 500_000), (5000, 7, 0)])
def test_all_pages_come_back(spark, tmp_path, archive_bytes, block_captures, most):
    rows = pages()
    df = make(spark, rows).repartition(3)
    folder = f"file://{tmp_path}/archives"
    index = op.build_index(op.write_pages(df, folder, archive_bytes, most), folder, block_captures)
    assert read(index, op.page_columns(df).select("url", "page_id")) == expected(rows)
    # The files are gzip files of records, one member each.
    files = [f"{tmp_path}/archives/{name}" for name in os.listdir(f"{tmp_path}/archives")]
    text = b"".join(gzip.open(file).read() for file in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    assert all(open(file, "rb").read(2) == b"\x1f\x8b" for file in files)
    assert len(files) <= 3 if archive_bytes > 5000 else len(files) > 20


def test_only_what_is_asked_for_is_found(spark, tmp_path):
    rows = pages()
    folder = f"file://{tmp_path}/archives"
    index = op.archive_pages(make(spark, rows), folder, block_captures=11)
    asked = [(rows[3][1], 3), (rows[3][1], 3), (rows[4][1], 99), ("http://hot.example.org/", 450), ("http://nowhere.net/", 1), (None, 600), ("http://same.org", 700)]
    df = spark.createDataFrame(asked, "url string, page_id long")
    wanted = [r for r in rows if r[0] in (3, 450, 600, 700)]
    every = {r[0]: r for r in expected(rows)}
    assert read(index, df) == sorted((every[r[0]] for r in wanted), key=str)
    with_text = op.read_captures(index, op.locate(index, df.where("page_id = 3")), with_payload=True).collect()
    assert [(r.page_id, r.payload.decode()) for r in with_text] == [(3, rows[3][2])]


def test_no_pages(spark, tmp_path):
    index = op.archive_pages(make(spark, []), f"file://{tmp_path}/archives")
    assert read(index, spark.createDataFrame([("http://a.org", 1)], "url string, page_id long")) == []


def test_keys_sort_hosts_backwards():
    assert op.url_key("https://www.Example.org:443/a?b") == "org,example,www)/a?b"
    assert op.url_key("http://example.org:8080") == "org,example:8080)/"
    assert op.url_key("http://10.0.0.1/x") == "10.0.0.1)/x"
    assert op.url_key("mailto:x") == "mailto:x" and op.url_key("http://[bad") == "http://[bad" and op.url_key(None) == ""


def test_a_changed_payload_is_an_error():
    data = b"payload " * 20
    good = compose(1, "http://a.org/", data, hashlib.sha256(data).hexdigest(), None)
    assert parse(good).payload == data
    with pytest.raises(ValueError, match="digest"):
        parse(compose(1, "http://a.org/", data, hashlib.sha256(b"other").hexdigest(), None))
