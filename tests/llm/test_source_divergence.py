from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ordersight.llm import source_divergence as op
from ordersight.llm.byte_words import chunks
from ordersight.llm.letter_runs import distinct, runs, strings, wide_letters
from ordersight.llm.perfect_hash import Shards, build

from .conftest import prose, table

LOWER = {c: c + 32 for c in range(65, 91)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least):
    """(lang, source, part, item, value, rank) from (text, lang, source) in plain Python."""
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for text, lang, source in rows]
    result = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        spread = Counter(t for d in own for t in d[2])
        kept = sorted(t for t, n in spread.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update({t: terms[t] for t in kept if t in terms})

        def share(count, whole):
            return 1 + 10**9 * (count + 5) // (whole + 5 * len(kept))

        p = {s: {t: share(c[t], c.total()) for t in kept} for s, c in counts.items()}
        every = sum(counts.values(), Counter())
        q = {t: share(every[t], every.total()) for t in kept}
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, 50)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                result += [(lang, s, part, item, value, at + 1) for at, (item, value) in enumerate(ranked)]
    return sorted(result)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def corpus(spark):
    rows = [(i, prose(i % 40, 60) + " É" * (i % 3) + " Größe", "en" if i % 3 else "de", f"s{i % 7}") for i in range(90)]
    rows += [(200, None, "en", "empty"), (201, "12 !!", None, None), (202, "a" * 3000, None, ""), (203, None, "xx", "a"), (204, None, "xx", "b"), (None, prose(1, 60), "en", None)]
    rows += [rows[4]] * 30
    return table(spark, [(*r, 0) for r in rows])


@pytest.mark.parametrize(("shard_terms", "block_bytes"), [(1 << 15, 48 << 20), (7, 1500)])
def test_against_brute_force(spark, shard_terms, block_bytes):
    docs = corpus(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    tiles = {} if shard_terms > 7 else {"tile_sources": 2, "tile_slots": 16}
    result = op.source_divergence(docs, least_docs=4, shard_terms=shard_terms, block_bytes=block_bytes, **tiles)
    assert found(result) == brute(rows, 4)


def test_odd_and_empty(spark, odd, empty):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert found(op.source_divergence(odd, least_docs=1)) == brute(rows, 1)
    assert found(op.source_divergence(odd)) == brute(rows, 30)
    assert found(op.source_divergence(empty)) == []


def test_sources_that_lack_the_terms_of_some_tiles(spark):
    words = [a + b for a in "abcdefgh" for b in "abcdefgh"]
    texts = {"all": words, "first": words[:20], "last": words[40:], "one": words[30:31], "none": []}
    rows = [(i, " ".join(kept), "en", source, 0) for i, (source, kept) in enumerate(sorted(texts.items()) * 4)]
    result = op.source_divergence(table(spark, rows), least_docs=4, tile_slots=8)
    assert found(result) == brute([r[1:4] for r in rows], 4)


def test_perfect_hash_tells_members_from_others():
    words = [f"w{'x' * (i % 5)}" + "".join(chr(97 + int(c)) for c in str(i)) for i in range(5000)]
    _, data, offsets = next(chunks(pa.array([" ".join(words)])))
    text = runs(data, offsets, wide_letters(data))
    example, kind = distinct(text)
    assert len(example) == 5000 and strings(text, example[kind]).to_pylist() == words
    members = np.arange(0, 5000, 2)
    sizes, bits, order, left = build(text.hashes[members])
    assert sorted(order) == list(range(2500)) and not len(left)
    shards = Shards([sizes], [bits], [strings(text, members[order])])
    slots = shards.find(text, np.arange(5000), np.zeros(5000, int))
    assert sorted(slots[members]) == list(range(2500)) and (slots[1::2] == -1).all()


def test_words_with_equal_hashes_stay_apart():
    _, data, offsets = next(chunks(pa.array(["one two three one two"])))
    text = runs(data, offsets, wide_letters(data))
    text.hashes[:] = np.uint64(7)
    example, kind = distinct(text)
    assert strings(text, example).to_pylist() == ["one", "two", "three"] and kind.tolist() == [0, 1, 2, 0, 1]
    sizes, bits, order, left = build(text.hashes[example])
    assert not len(order) and sorted(left) == [0, 1, 2]
    shards = Shards([sizes], [bits], [strings(text, example[left])])
    slots = shards.find(text, np.arange(5), np.zeros(5, int))
    assert sorted(set(slots)) == [0, 1, 2] and slots[0] == slots[3] and slots[1] == slots[4]
