from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordersight.llm import byte_words, repeats
from tests.llm.conftest import odd_rows, prose, table


def expected(rows):
    """By definition: windows of 50 bytes in dictionaries."""
    first, out = {}, []
    rows = sorted(((i, (t or "").encode()) for i, t in rows if i is not None), key=lambda r: r[0])
    for i, data in rows:
        for p in range(len(data) - 49):
            first.setdefault(data[p : p + 50], i)
    for i, data in rows:
        hit = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < i:
                hit[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, h in zip(data, hit) if not h)
        out.append((i, len(data), sum(hit), len(bytes(hit).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(docs):
    cut = repeats.remove_repeats(docs, "doc_id", "text").where("row.doc_id is not null")
    rows = cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    return sorted(tuple(r) for r in rows)


def test_odd_rows(odd):
    assert found(odd) == expected(odd_rows())


def test_rows_without_id_are_whole(odd):
    rows = repeats.remove_repeats(odd, "doc_id", "text").where("row.doc_id is null").select("n_removed").collect()
    assert [r.n_removed for r in rows] == [0, 0]


def test_one_id_with_two_texts_is_whole(spark):
    rows = [(1, prose(5, 60)), (2, prose(5, 60)), (2, prose(6, 60)), (3, prose(6, 60))]
    cut = repeats.remove_repeats(table(spark, rows), "doc_id", "text")
    assert sorted((r[0], r[1]) for r in cut.select("row.doc_id", "n_removed").collect()) == [(1, 0), (2, 0), (2, 0), (3, 0)]


def test_empty(empty):
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("crowd", [500, 2])
def test_overlapping_passages(spark, monkeypatch, crowd):
    """Passages in many contexts, copies with edits, periodic texts; also when every hash is crowded."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    draw = random.Random(3)
    passage, other = prose(50, 12), prose(51, 9)
    rows = []
    for i in range(40):
        text = prose(100 + i, 8) + passage[draw.randrange(20) :] + prose(200 + i, 5) + other + "xyxy" * draw.randrange(40)
        rows.append((i, text))
        if i % 5 == 0:
            rows.append((100 + i, text[:150] + "?" + text[160:]))
    assert found(table(spark, rows)) == expected(rows)


def test_whole_characters(spark):
    text = "é" * 60
    rows = [(1, text), (2, "a" + text + "日本")]
    cut = repeats.remove_repeats(table(spark, rows), "doc_id", "text", as_text=True).where("row.doc_id = 2").first()
    assert cut.kept == "a日本"


def test_groups_of_the_transform():
    """Against sorted suffixes compared directly."""
    draw = random.Random(8)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 40))) for _ in range(30)]
    data, symbols = "", []
    for k, t in enumerate(texts):
        symbols += [ord(c) + len(texts) for c in t] + [k]
        data += t + "\0"
    order, group = repeats.bwt_groups(np.array(symbols), 6)
    prefix = {}
    for at, g in zip(order, group):
        here = data[at : at + 6]
        if "\0" not in here and len(here) == 6:
            prefix.setdefault(g, set()).add(here)
    assert all(len(p) == 1 for p in prefix.values())
    assert len(prefix) == len({x for t in texts for x in (t[i : i + 6] for i in range(len(t) - 5))})


class _Taken:
    """Takes the function a step gives to Spark."""

    def select(self, *columns):
        return self

    def mapInArrow(self, step, schema):
        self.step = step
        return self


def test_units_of_a_batch_are_bounded(monkeypatch):
    """A batch of many bytes is cut unit by unit and handed on in small batches."""
    taken = _Taken()
    repeats._entries(taken, 50)
    texts = [prose(i, 3000) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    sizes = []
    whole = repeats._packed_entries

    def watched(spread, *rest):
        sizes.append(int(rest[3].sum()))
        return whole(spread, *rest)

    monkeypatch.setattr(repeats, "_packed_entries", watched)
    monkeypatch.setattr(repeats, "UNIT_BYTES", 300_000, raising=False)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 50_000, raising=False)
    monkeypatch.setattr(byte_words.chunks, "__defaults__", (100_000,))
    given = list(taken.step(iter([batch])))
    assert len(sizes) > 1 and max(sizes) <= 300_000 and sum(sizes) == sum(len(t) - 49 for t in texts)
    assert max(b.nbytes for b in given) < 100_000
    assert sum(len(w.as_py()) // 4 for b in given for w in b.column("start")) == sum(len(w.as_py()) // 4 for b in given for w in b.column("windows"))
    counts = [repeats._unpack(w.as_py(), "<u4").sum() for b in given for w in b.column("windows")]
    assert sum(counts) == sum(sizes)


def test_small_units_give_the_same(spark, monkeypatch):
    """Windows of a crowd in units, texts in small groups: results by definition."""
    line = prose(70, 14)
    rows = [(i, prose(300 + i, 2) + " " + line + prose(900 + i, 2)) for i in range(120)]
    monkeypatch.setattr(repeats, "CROWD", 20)
    monkeypatch.setattr(repeats, "UNIT_WINDOWS", 50, raising=False)
    monkeypatch.setattr(repeats, "CUT_DOCS", 7, raising=False)
    assert found(table(spark, rows)) == expected(rows)
