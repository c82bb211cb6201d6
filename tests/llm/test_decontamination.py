from __future__ import annotations

import re

import pytest

from ordersight.llm import decontamination
from tests.llm.conftest import odd_rows, prose, table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    data = (text or "").encode()
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in data))


def expected(docs, items):
    out = []
    for doc, text in docs:
        w = words(text)
        hit, seen = set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(len(v), 10)
            if item is None or not n:
                continue
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    seen.add(item)
        out.append((doc, len(w), len(hit), sorted(seen)))
    return sorted(out, key=repr)


ITEMS = [
    (1, prose(1, 120)[100:400]), (2, prose(99, 6000)[2000:2300].upper()), (3, "one"), (4, None), (5, ""), (6, "..."),
    (7, prose(6, 80)), (8, prose(6, 80)), (9, prose(77, 30)), (None, prose(1, 30)), (10, "straße 日本語テキスト"), (11, "Ünïcödé"),
]


@pytest.mark.parametrize("block", [100_000, 7])
def test_odd_rows(spark, odd, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination.find_contamination(odd, items, "doc_id", "text", block_pairs=block)
    rows = [(r.row.doc_id, r.n_words, sum(s.past - s.first for s in r.spans), r["items"]) for r in found.collect()]
    assert sorted(rows, key=repr) == expected([r[:2] for r in odd_rows()], ITEMS)


def test_empty_tables(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.find_contamination(empty, items).count() == 0
    none = decontamination.find_contamination(odd, items.where("false"))
    assert none.count() == odd.count() and none.where("size(items) > 0").count() == 0


def test_columns_stay(odd, spark):
    found = decontamination.find_contamination(odd, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert found.select("row.*").columns == odd.columns


def test_random_overlaps(spark):
    """Few different words, so windows overlap and repeat."""
    import random

    draw = random.Random(2)
    line = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    items = [(k, line(draw.randrange(1, 16))) for k in range(12)]
    docs = [(k, line(draw.randrange(0, 300))) for k in range(25)]
    found = decontamination.find_contamination(table(spark, docs), spark.createDataFrame(items, "item_id long, text string"), "doc_id", "text")
    rows = [(r.row.doc_id, r.n_words, sum(s.past - s.first for s in r.spans), r["items"]) for r in found.collect()]
    assert sorted(rows, key=repr) == expected(docs, items)
