"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

The leaves of a document's tree are the token counts of its pre-tokens, each node
is the sum of two below it, and the root is the document's count. An edit replaces a
range of characters. Only the stretch it touches is encoded again, widened on both sides
to the next white space, as no pre-token reaches over white space; its count goes to the
first leaf of the stretch, the other leaves become 0, and the sums above them
are brought up to date.

``op3_token_counts`` counts all documents before and after the edits of a
redaction: every e-mail address and every number in the form of a telephone
number gives way to a placeholder.

Defined cases: null and empty texts count 0; edits are sorted and must not
overlap, and their ends are cut to the text; edits that share a stretch are
applied together; repeated rows are counted alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.llm.pretokens import Encoder, encoder
from ordersight.llm.tables import as_rows, table

#: (first character, character past the last, replacement).
Edit = tuple[int, int, str]
#: White space below U+0100 as the tokenizer's pattern sees it.
SPACES = frozenset("\t\n\v\f\r \x85\xa0")
_MAIL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_PHONE = re.compile(r"(?<![\w.-])\+?(?:\d{1,3}[-. ])?\(?\d{3}\)?[-. ]\d{3,4}(?:[-. ]\d{4})?(?![\w-])")


class SegmentTree:
    """Sums over leaves; ``levels[0]`` are the leaves, ``levels[-1]`` the root."""

    def __init__(self, leaves: np.ndarray):
        level = np.append(leaves, 0) if not len(leaves) else leaves.astype(np.int64)
        self.levels = [level]
        while len(level) > 1:
            level = np.append(level, 0) if len(level) % 2 else level
            level = level[::2] + level[1::2]
            self.levels.append(level)

    @property
    def total(self) -> int:
        return int(self.levels[-1][0])

    def replace(self, first: int, past: int, count: int) -> None:
        """Leaves ``first`` to ``past`` - 1 become one with ``count``; without leaves it is added to a neighbour."""
        leaves = self.levels[0]
        if first == past:
            first = min(first, len(leaves) - 1)
            leaves[first] += count
            past = first + 1
        else:
            leaves[first] = count
            leaves[first + 1 : past] = 0
        low, high = first, past - 1
        for below, above in zip(self.levels, self.levels[1:]):
            low, high = low // 2, high // 2
            pairs = below[2 * low : 2 * high + 2]
            above[low : high + 1] = np.add.reduceat(pairs, np.arange(0, len(pairs), 2))


def stretches(text: str, edits: list[Edit]) -> list[tuple[int, int, str]]:
    """(first, past, new text) of the stretches between white space that edits touch."""
    out: list[list] = []
    for first, past, new in sorted(edits):
        past = min(past, len(text))
        first = min(first, past)
        left, right = first, past
        while left > 0 and text[left - 1] not in SPACES:
            left -= 1
        while right < len(text) and text[right] not in SPACES:
            right += 1
        if out and left <= out[-1][1]:
            out[-1][1] = max(out[-1][1], right)
            out[-1][2].append((first, past, new))
        else:
            out.append([left, right, [(first, past, new)]])
    return [(left, right, apply_edits(text[left:right], [(a - left, b - left, n) for a, b, n in own])) for left, right, own in out]


def apply_edits(text: str, edits: list[Edit]) -> str:
    parts, at = [], 0
    for first, past, new in edits:
        parts += [text[at:first], new]
        at = past
    return "".join([*parts, text[at:]])


def count_edited(coder: Encoder, texts: list[str], edits: list[list[Edit]]) -> list[tuple[int, int, int]]:
    """Per text: tokens, tokens after its edits, pre-tokens that were replaced."""
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(texts)
    plain = [coder.plain(t) for t in texts]
    rows = [k for k, p in enumerate(plain) if p is not None]
    found = coder.entries([plain[k] for k in rows])
    counts = coder.counts[found.entries]
    shift = np.append(0, np.cumsum([len(plain[k]) for k in rows]))
    trees = {}
    for at, row in enumerate(rows):
        a, b = found.bounds[at], found.bounds[at + 1]
        tree = SegmentTree(counts[a:b])
        out[row] = (tree.total, tree.total, 0)
        if edits[row]:
            trees[row] = (tree, found.starts[a:b] - shift[at])
    # Texts beyond Latin-1 get their leaves from the tokenizer's split.
    others = [k for k, p in enumerate(plain) if p is None]
    for row, (starts, sizes) in zip(others, coder.parts([texts[k] for k in others])):
        tree = SegmentTree(sizes)
        out[row] = (tree.total, tree.total, 0)
        if edits[row]:
            trees[row] = (tree, starts)
    pending = []
    for row, (tree, starts) in trees.items():
        for left, right, new in stretches(texts[row], edits[row]):
            first, past = np.searchsorted(starts, [left, right])
            pending.append((row, int(first), int(past), new))
    # Stretches without pre-tokens are added to a neighbour, so they come last.
    pending.sort(key=lambda p: p[1] == p[2])
    for (row, first, past, _), ids in zip(pending, coder.ids([p[3] for p in pending])):
        trees[row][0].replace(first, past, len(ids))
        before, _, redone = out[row]
        out[row] = (before, trees[row][0].total, redone + past - first)
    return out


def redactions(text: str) -> list[Edit]:
    found = [(m.start(), m.end(), "<mail>") for m in _MAIL.finditer(text)] if "@" in text else []
    taken = [(a, b) for a, b, _ in found]
    for m in _PHONE.finditer(text):
        if not any(a < m.end() and m.start() < b for a, b in taken):
            found.append((m.start(), m.end(), "<phone>"))
    return found


def count_tokens(docs: DataFrame, tokenizer: str, *columns: str, edits_of: Callable[[str], list[Edit]] = redactions) -> DataFrame:
    """``row`` (the named columns, with ``text``), ``n_tokens``, ``n_edits``, ``n_tokens_edited``, ``n_replaced``."""
    rows = as_rows(docs, *columns)
    names = ("n_tokens", "n_edits", "n_tokens_edited", "n_replaced")
    schema = T.StructType([rows.schema["row"], *(T.StructField(n, T.LongType()) for n in names)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column("row").field("text").to_pylist()]
                edits = [edits_of(t) for t in texts]
                found = count_edited(coder, texts, edits)
                columns = ([f[0] for f in found], [len(e) for e in edits], [f[1] for f in found], [f[2] for f in found])
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(c, pa.int64()) for c in columns)], ["row", *names])

    return rows.mapInArrow(count, schema)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), "doc_id", "text")
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "n_edits", "n_tokens_edited", "n_replaced")
