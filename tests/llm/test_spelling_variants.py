from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordersight.llm import spelling_variants as op
from ordersight.llm.edit_automata import Acceptor

from .conftest import prose, table

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 5}
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    result = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        result.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(result)


def corpus():
    """Words with variants of variants, runs of one letter, and long words that share a long beginning or end."""
    draw = random.Random(3)
    words = {"strasse": 900, "strase": 170, "strade": 30, "stradé": 6, "Straßen": 6}
    words |= {"a" * k: 5 + 40 * (k % 5 == 0) for k in range(6, 30)}
    base = "".join(draw.choice("abcdefghij") for _ in range(40))
    for _ in range(60):
        at, letter = draw.randrange(40), draw.choice("abcÿÀ×")
        words[draw.choice([base[:at] + letter + base[at + 1 :], base[:at] + letter + base[at:], base[:at] + base[at + 1 :]])] = draw.choice([5, 7, 300])
    for _ in range(150):
        words["prefix" + "".join(draw.choice("ab") for _ in range(draw.randrange(2, 6)))] = draw.choice([4, 5, 26])
        words["".join(draw.choice("ab") for _ in range(draw.randrange(2, 6))) + "suffix"] = draw.choice([4, 5, 26])
    words["b" * 3000], words["b" * 3001] = 5, 60
    every = [w for w, n in words.items() for _ in range(n)]
    draw.shuffle(every)
    rows = [(i, ", ".join(every[at : at + 50])) for i, at in enumerate(range(0, len(every), 50))]
    return rows + [(i + 10_000, prose(i, 80)) for i in range(20)] + [(5, None), (6, ""), (7, "1 2 !"), (None, "Größen " * 9), (8, "same words here " * 9)] + [(9, "repeated rowsss")] * 5


@pytest.mark.parametrize(("most_words", "task_entries"), [(20_000, 40_000), (3, 100)])
def test_against_brute_force(spark, most_words, task_entries):
    rows = corpus()
    found = op.spelling_variants(table(spark, rows), most_words, task_entries)
    found = sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())
    expected = brute(rows)
    assert found == expected
    assert len([r for r in expected if r[2] != r[0] and r[2] != r[1]]) > 0


def test_odd_and_empty(spark, odd, empty):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(tuple(r) for r in op.spelling_variants(odd).select(*columns).collect()) == brute(rows)
    assert op.spelling_variants(empty).collect() == []


def test_checksums_of_joined_strings():
    draw = random.Random(1)
    pairs = [(draw.randbytes(draw.randrange(20)), draw.randbytes(draw.choice([0, 1, 5, 300, 70_000]))) for _ in range(60)]
    first, second = (np.array([zlib.crc32(p[i]) for p in pairs], np.uint32) for i in (0, 1))
    joined = op.joined_crc(first, second, np.array([len(p[1]) for p in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_composition_accepts_each_near_pair_once():
    draw = random.Random(2)
    for _ in range(30):
        words = sorted({"".join(draw.choice("aab") for _ in range(draw.randrange(7))) for _ in range(25)})
        machine = Acceptor()
        found = list(machine.near_pairs(machine.add_group(words)))
        assert len(found) == len(set(found))
        assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if a != b and one_edit(a, b)}
        assert len(found) == len({frozenset(p) for p in found})


def test_equal_endings_share_states():
    machine = Acceptor()
    first = machine.add_group(["xing", "ying"])
    assert machine.moves[first]["x"] == machine.moves[first]["y"]
    assert machine.add_group(["xing", "ying"]) == first
