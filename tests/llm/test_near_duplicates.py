from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from ordersight.llm import near_duplicates as nd
from ordersight.llm.components import components
from tests.llm.conftest import odd_rows, prose, table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def weighted(texts):
    sets = []
    for text in texts:
        w = WORD.findall((text or "").encode().lower())
        n = min(5, len(w))
        sets.append(Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else Counter())
    df = Counter(k for s in sets for k in s)
    n = len(texts)
    least = max(2, math.ceil(n * nd.FREQUENT))
    weight = {k: math.log(1 + n / c) if c >= least else math.log(1 + 1 / nd.FREQUENT) for k, c in df.items()}
    return [{k: c * weight[k] for k, c in s.items()} for s in sets]


def expected(rows):
    rows = [(i, t) for i, t in rows if i is not None]
    sets = weighted([t for _, t in rows])
    parent = {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, text) in enumerate(rows):
        for b in range(a):
            shared = sum(min(w, sets[b].get(k, 0)) for k, w in sets[a].items())
            total = sum(sets[a].values()) + sum(sets[b].values()) - shared
            if (text or "") == (rows[b][1] or "") or total and shared / total >= nd.SIMILAR:
                x, y = top(i), top(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted({(i, top(i)) for i, _ in rows})


def found(docs):
    return sorted(tuple(r) for r in nd.near_duplicate_classes(docs).collect())


def edited(text, words, at):
    parts = text.split(" ")
    for k in range(words):
        parts[(at + 17 * k) % len(parts)] = "changed"
    return " ".join(parts)


def test_odd_rows(odd):
    assert found(odd) == expected(odd_rows())


def test_empty(empty):
    assert found(empty) == []


def test_chains_and_large_groups(spark):
    """A group of many near copies, a chain whose ends are not similar, passages shared by dissimilar texts."""
    base = prose(1, 200)
    rows = [(k, edited(base, 1 + k % 2, 3 * k)) for k in range(60)]
    step = prose(2, 150).split(" ")
    rows += [(100 + k, " ".join(step[6 * k : 6 * k + 110])) for k in range(6)]
    shared = prose(3, 70)
    rows += [(200 + k, shared + " " + prose(300 + k, 60)) for k in range(30)]
    assert found(table(spark, rows)) == expected(rows)


def test_similar_but_not_near(spark, monkeypatch):
    """Copies of one text that are near it and not near each other, in blocks of a few units."""
    monkeypatch.setattr(nd, "BLOCK_UNITS", 7)
    base = prose(4, 220)
    rows = [(k, edited(base, 8, 5 * k)) for k in range(50)] + [(90, base)]
    rows += [(100 + k, edited(edited(prose(5, 160), 5, k), 1, 3 * k)) for k in range(40)]
    assert found(table(spark, rows)) == expected(rows)
    assert found(table(spark, rows[:50])) == expected(rows[:50])


def test_an_id_with_two_texts(spark):
    one, other = prose(6, 90), prose(7, 90)
    rows = [(5, one), (5, other), (1, one), (2, other), (3, prose(8, 90))]
    for order in (rows, rows[::-1]):
        assert found(table(spark, order)) == expected(order) == [(1, 1), (2, 1), (3, 3), (5, 1)]


def test_samples_agree_as_often_as_weights_overlap():
    draw = np.random.default_rng(5)
    hashes = np.sort(draw.integers(1, 2**63, 4000).astype(np.uint64))
    one, other = np.ones(4000), np.ones(4000)
    other[::4] = 3.0
    keys = [nd.samples(np.zeros(4000, np.int64), hashes, w, 1.0)[1][0] for w in (one, other)]
    jaccard = np.minimum(one, other).sum() / np.maximum(one, other).sum()
    agreed = np.mean([nd.samples(np.zeros(200, np.int64), hashes[k : k + 200], one[:200], 1.0)[1][0] == nd.samples(np.zeros(200, np.int64), hashes[k : k + 200], other[:200], 1.0)[1][0] for k in range(0, 4000, 200)])
    assert abs(agreed - jaccard) < 0.05 and len(keys[0]) == nd.SAMPLES


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (7, 7)], "a long, b long")
    rows = {r.id: r.component for r in components(links).collect()}
    assert rows == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}
