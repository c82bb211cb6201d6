from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordersight.llm import packing, token_counts
from ordersight.llm.pretokens import Encoder
from tests.llm.conftest import odd_rows, prose, table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_round_trip(odd, tokenizer):
    pieces = packing.pack_documents(odd, PATH).collect()
    texts = {}
    for i, t in odd_rows():
        texts.setdefault(i, []).append(ids_of(tokenizer, t))
    for i, wanted in texts.items():
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: (p.start, p.length))
        assert sum(p.length for p in mine) == sum(len(w) for w in wanted)
        assert {p.doc_tokens for p in mine} == {len(w) for w in wanted}
        for p in mine:
            assert any(len(w) == p.doc_tokens and zlib.crc32(w[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for w in wanted)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    assert sum(sum(n for _, n in s) < packing.WINDOW for s in sequences.values()) <= 1


def test_empty(empty):
    assert packing.pack_documents(empty, PATH).count() == 0


def test_neighbours_share_words():
    """A seed is filled with the text on its subject."""
    draw = np.random.default_rng(1)
    subjects = [draw.integers(k * 100, k * 100 + 60, (6, 50)) for k in range(5)]
    ids = [np.concatenate([t, draw.integers(900, 1000, 10)]) for s in subjects for t in s]
    sequences = list(packing.pack(np.full(30, 60), ids, 120))
    assert len(sequences) == 15 and all(sum(n for *_, n in s) == 120 for s in sequences)
    assert sum(len({t // 6 for t, *_ in s}) == 1 for s in sequences) >= 14


def test_all_terms_of_a_seed_count():
    """The order is that of BM25 over all terms, also of a seed with hundreds, and after used texts are left out."""
    draw = np.random.default_rng(3)
    ids = [np.minimum(draw.zipf(1.2, draw.integers(20, 800)), 3000) for _ in range(60)]
    index, unused = packing.Index(ids), np.ones(60, bool)
    sizes = np.array([len(x) for x in ids])
    for used in (0, 1, 25):
        unused[draw.permutation(60)[:used]] = False
        index.shrink(unused)
        for seed in np.argsort(-sizes)[:5]:
            scores = np.zeros(60)
            for term in np.unique(ids[seed]):
                times = np.array([(x == term).sum() for x in ids])
                rarity = np.log1p((60 - (times > 0).sum() + 0.5) / ((times > 0).sum() + 0.5))
                scores += rarity * times * (packing.K1 + 1) / (times + packing.K1 * (1 - packing.B + packing.B * sizes / sizes.mean()))
            mine = index.neighbours(ids[seed], unused)
            assert sorted(mine) == np.flatnonzero(unused & (scores > 0)).tolist()
            assert np.allclose(scores[mine], np.sort(scores[mine])[::-1])


def test_sequences_do_not_depend_on_the_matrix(monkeypatch):
    """Scores are the same bit by bit, whichever terms are rows of the matrix and however many seeds share a product."""
    draw = np.random.default_rng(8)
    ids = [np.minimum(draw.zipf(1.3, draw.integers(1, 150)), 2000) for _ in range(300)]
    sizes = np.array([len(x) for x in ids])
    found = []
    for sparse, cells, seeds in ((32, 6 << 20, 32), (2, 6 << 20, 7), (32, 2000, 32), (32, 0, 1)):
        monkeypatch.setattr(packing, "SPARSE", sparse)
        monkeypatch.setattr(packing, "MATRIX_CELLS", cells)
        monkeypatch.setattr(packing, "SEEDS_AT_ONCE", seeds)
        found.append(list(packing.pack(sizes, ids, 160)))
    assert all(f == found[0] for f in found)
    assert sum(n for s in found[0] for *_, n in s) == sizes.sum()


def test_shards_by_content(spark, monkeypatch):
    """Small shards: statistics of all documents, texts alike together, and rows of a null id in several shards."""
    monkeypatch.setattr(packing, "SHARD_BYTES", 4000)
    rows = [(100 * k + c, prose(k, 60)) for c in range(2) for k in range(40)] + [(None, prose(500, 60))] * 60
    coded = packing._coded(table(spark, rows).selectExpr("doc_id", "text", "cast(octet_length(text) + 16 as long) bytes"), PATH)
    statistics = packing.statistics_of(coded)
    ids = Encoder(PATH).ids([t for _, t in rows])
    true = np.bincount(np.concatenate([np.unique(np.append(x, packing.END)) for x in ids]))
    assert statistics.documents == len(rows) and statistics.frequency.tolist() == true.tolist()
    assert np.isclose(statistics.mean, np.mean([len(x) + 1 for x in ids]))
    dealt, shards = packing._dealt(coded, statistics)
    found = [(r.doc_id, r.shard, r.bytes) for r in dealt.collect()]
    place = {i: s for i, s, _ in found if i is not None}
    assert shards > 10 and all(place[100 * k] == place[100 * k + 1] for k in range(40))
    amounts = {}
    for _, shard, size in found:
        amounts[shard] = amounts.get(shard, 0) + size
    assert len({s for i, s, _ in found if i is None}) > 3 and max(amounts.values()) < 4 * packing.SHARD_BYTES


def test_ids_are_the_tokenizers(tokenizer):
    coder = Encoder(PATH)
    draw = random.Random(6)
    texts = ["".join(draw.choice("abstdmrevl'' \n\t!é9²_-Ü<|>日\x1c\xa0") for _ in range(draw.randrange(15))) for _ in range(600)]
    texts += [t or "" for _, t in odd_rows()]
    assert [x.tolist() for x in coder.ids(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_table_starts_anew_when_full(tokenizer, monkeypatch):
    from ordersight.llm import pretokens

    monkeypatch.setattr(pretokens, "TABLE_BITS", 8)
    coder = Encoder(PATH)
    for seed in range(8):
        text = prose(seed, 60)
        assert coder.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_edited_counts(tokenizer):
    """Random edits, with ends inside words, at blanks, and at the ends of a text."""
    coder = Encoder(PATH)
    draw = random.Random(12)
    for _ in range(300):
        text = "".join(draw.choice("ab c'sé9! \n日") for _ in range(draw.randrange(40)))
        cuts = sorted(draw.sample(range(len(text) + 1), min(len(text) + 1, 2 * draw.randrange(3))))
        edits = [(a, b, draw.choice(["", "x", " ", "new 'll words", "日"])) for a, b in zip(cuts[::2], cuts[1::2])]
        before, after, _ = token_counts.count_edited(coder, [text], [edits])[0]
        assert before == len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert after == len(tokenizer.encode(token_counts.apply_edits(text, edits), add_special_tokens=False).ids)


@pytest.mark.parametrize("letters", ["аб Ёж, “x”—1\u0301", "日本語。 x\u3000y", "가각\u1100\u1161 é\u0327 ", ["a", "“", " ", "<|endoftext|>", "<|", "|>"]])
def test_edited_counts_beyond_latin(tokenizer, letters):
    """Random edits of texts that the tokenizer splits itself, also with special tokens."""
    coder = Encoder(PATH)
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(40)))
        cuts = sorted(draw.sample(range(len(text) + 1), min(len(text) + 1, 2 * draw.randrange(3))))
        edits = [(a, b, draw.choice(["", " ", "'ll", "語", "\u0301", "<|endoftext|>"])) for a, b in zip(cuts[::2], cuts[1::2])]
        before, after, _ = token_counts.count_edited(coder, [text], [edits])[0]
        assert before == len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert after == len(tokenizer.encode(token_counts.apply_edits(text, edits), add_special_tokens=False).ids)


def test_a_curly_quote_changes_no_leaf():
    coder = Encoder(PATH)
    text = prose(4, 500) + " write to someone@example.com now"
    replaced = [token_counts.count_edited(coder, [t], [token_counts.redactions(t)])[0][2] for t in (text, text + " ”")]
    assert replaced[0] == replaced[1] < 8


def test_only_what_an_edit_touches_is_encoded_again():
    coder = Encoder(PATH)
    text = prose(4, 500) + " write to someone@example.com now"
    _, _, replaced = token_counts.count_edited(coder, [text], [token_counts.redactions(text)])[0]
    assert 0 < replaced < 8


def test_segment_tree():
    draw = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 64, 100):
        leaves = draw.integers(0, 9, n)
        tree = token_counts.SegmentTree(leaves)
        assert tree.total == leaves.sum()
        if n > 3:
            tree.replace(1, 3, 50)
            assert tree.total == leaves.sum() - leaves[1:3].sum() + 50
        tree.replace(n, n, 5)
        assert tree.total == tree.levels[0].sum()


def test_counts_of_odd_rows(odd, empty, tokenizer):
    rows = token_counts.count_tokens(odd, PATH).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        text = r.row.text or ""
        assert r.n_tokens == len(ids_of(tokenizer, text)) - 1
        assert r.n_tokens_edited == len(ids_of(tokenizer, token_counts.apply_edits(text, sorted(token_counts.redactions(text))))) - 1
    assert token_counts.count_tokens(empty, PATH).count() == 0


def test_redactions(spark, tokenizer):
    docs = table(spark, [(1, "mail a.b@c.org or call +1 555 123 4567, not 12 or 1999")])
    row = token_counts.count_tokens(docs, PATH).first()
    assert row.n_edits == 2
    assert row.n_tokens_edited == len(ids_of(tokenizer, "mail <mail> or call <phone>, not 12 or 1999")) - 1
