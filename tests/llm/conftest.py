"""Small corpora: ordinary texts, and rows with everything odd in them."""

from __future__ import annotations

import random

import pytest

WORDS = "the of and river stone light over under house garden winter summer paper music window people little great never always".split()
#: Extra columns whose names the operators use inside.
CLASHING = ["row", "doc", "kind", "shard", "score", "ranges", "id", "n_words", "spans", "class", "bucket", "label", "key", "size"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def prose(seed: int, words: int) -> str:
    """Words that hardly repeat: each is a common one and a number in letters."""
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + "".join(chr(97 + draw.randrange(26)) for _ in range(3)) for _ in range(words))


def table(spark, rows):
    """(doc_id, text) or longer tuples as a table with clashing extra columns."""
    width = len(SCHEMA.split(", "))
    padded = [tuple(r) + ("en", "s", len(r[1] or ""))[len(r) - 2 :] + ("x",) * (width - 5) for r in rows]
    return spark.createDataFrame(padded, SCHEMA)


def odd_rows():
    long = prose(99, 6000)
    return [
        (1, prose(1, 120)),
        (2, None),
        (3, ""),
        (4, "!!! ... \n\n"),
        (5, long),
        (6, prose(6, 80)),
        (6, prose(6, 80)),
        (7, prose(6, 80)),
        (8, "one"),
        (9, "Ünïcödé ÀÉÎ straße 日本語テキスト " + prose(9, 40)),
        (10, "a" * 500),
        (11, "b" + "a" * 300),
        (12, long[:3000] + prose(12, 100)),
        (13, "<|endoftext|> don't 'stop they're 12 x² " + prose(1, 120)[200:400]),
        (None, prose(1, 120)),
        (None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return table(spark, odd_rows()).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])
