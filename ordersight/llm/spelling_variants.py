"""Spelling variants: rare words tied to a frequent word one edit away (op13).

1. Words are counted over all documents: runs of Latin letters, some of them with a letter
   deleted by rule (``deleted_letter``).
2. Two words one edit apart share their first or their last half: with M the length of the
   longer, the first M // 2 code points or the last M - M // 2. Each word goes to the groups it
   can have a partner in, and groups to tasks by hash.
3. A task builds the minimal acceptor of its words with one initial state per group and
   enumerates the pairs that acceptor, one-edit transducer and acceptor accept when composed
   (``edit_automata``).
4. Groups of more than ``MOST_WORDS`` words are cut by one more code point, again and again; pairs that differ
   at exactly that place have equal words around it, and are found by that.
5. A word's form is its most frequent near word, if frequent enough; roots follow by joins
   that double the steps.

Null or letterless texts have no words; a null doc_id counts as ''. Rows count as often as they
occur. Very long texts and words are whole. Ties go to the smallest word in code-point order. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm.byte_words import chunks
from ordersight.llm.edit_automata import Acceptor
from ordersight.llm.letter_runs import Runs, distinct, latin_letters, runs, spans, strings
from ordersight.llm.tables import partitions_for, ship_library, table
from ordersight.plans.shared_store import store

#: A run whose hash this divides loses a letter; words that count; how much more frequent a form is.
DELETED_EVERY = 199
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: Words of a group at most, and entries of a task.
MOST_WORDS, TASK_ENTRIES = 20_000, 40_000
TEXT_BYTES = 4 << 20
_POLYNOMIAL = np.uint32(0xEDB88320)


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """The register of a CRC-32 after one more zero byte (a linear map)."""
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), _POLYNOMIAL, np.uint32(0))
    return crc


#: For 2^k zero bytes and each of the four bytes of a register: its 256 images.
_SHIFTS: list[np.ndarray] = []


def _shift_tables(bits: int) -> list[np.ndarray]:
    while len(_SHIFTS) < bits:
        base = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]
        _SHIFTS.append(_zero_byte(base) if not _SHIFTS else _moved(_moved(base, _SHIFTS[-1]), _SHIFTS[-1]))
    return _SHIFTS


def _moved(crc: np.ndarray, images: np.ndarray) -> np.ndarray:
    eight = np.uint32(8)
    return images[0][crc & np.uint32(255)] ^ images[1][(crc >> eight) & np.uint32(255)] ^ images[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ images[3][crc >> np.uint32(24)]


def joined_crc(first: np.ndarray, second: np.ndarray, second_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings one after the other, from their own CRC-32 values."""
    crc, lengths = first.astype(np.uint32), second_bytes.astype(np.int64)
    for bit, images in enumerate(_shift_tables(int(lengths.max(initial=0)).bit_length())):
        some = (lengths >> bit) & 1 == 1
        crc[some] = _moved(crc[some], images)
    return crc ^ second.astype(np.uint32)


def deleted_letter(run: str, hashed: int) -> str:
    """What becomes of a run whose hash ``DELETED_EVERY`` divides."""
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n of a chunk of documents; short words are left out."""
    for batch in batches:
        ids = [f"{'' if d is None else d}:".encode() for d in batch.column("doc_id").to_pylist()]
        heads = np.array([zlib.crc32(d) for d in ids], np.uint32)
        for first, data, offsets in chunks(batch.column("text"), TEXT_BYTES):
            found = runs(data, offsets, latin_letters(data))
            if len(found.starts):
                yield _chunk_words(found, heads[first : first + len(offsets) - 1])


def _chunk_words(found: Runs, heads: np.ndarray) -> pa.RecordBatch:
    example, kind = distinct(found)
    lengths = found.ends - found.starts
    own = np.array([zlib.crc32(found.text(at)) for at in example], np.uint32)
    hashed = joined_crc(heads[found.owners], own[kind], lengths)
    changed = hashed % np.uint32(DELETED_EVERY) == 0
    counts = np.bincount(kind[~changed], minlength=len(example))
    # Code points: bytes that do not go on with a letter.
    begins = (found.data[spans(found.starts[example], lengths[example])] & 0xC0) != 0x80
    points = np.add.reduceat(begins.astype(np.int64), np.cumsum(lengths[example]) - lengths[example])
    whole = np.flatnonzero((counts > 0) & (points >= LEAST_LENGTH))
    cut: dict[str, int] = defaultdict(int)
    for at in np.flatnonzero(changed):
        word = deleted_letter(found.text(at).decode(), int(hashed[at]))
        if len(word) >= LEAST_LENGTH:
            cut[word] += 1
    words = pa.concat_arrays([strings(found, example[whole]), pa.array(list(cut), pa.string())])
    return pa.RecordBatch.from_arrays([words, pa.array(np.concatenate([counts[whole], np.array(list(cut.values()), np.int64)]))], ["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of all words of the documents that count."""
    read = docs.select(docs["`doc_id`"].cast("string").alias("doc_id"), docs["`text`"].cast("string").alias("text"))
    counted = read.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _entries(words: DataFrame) -> DataFrame:
    """Each word in its four groups: side, m, depth, body, n.

    ``body`` is the word, reversed on side ``tail``; its group are the words of the same side
    and m whose bodies begin with the same ``depth`` code points.
    """
    size = F.char_length("word")
    sides = []
    for m in (size, size + 1):
        half = F.floor(m / 2).cast("int")
        for side, depth, body in (("head", half, F.col("word")), ("tail", m - half, F.reverse("word"))):
            sides.append(F.struct(F.lit(side).alias("side"), m.alias("m"), depth.alias("depth"), body.alias("body"), "n"))
    return words.select(F.explode(F.array(*sides)).alias("entry")).select("entry.*")


def _key(depth: Column) -> Column:
    return F.substring("body", F.lit(1), depth)


def _cut_large(entries: DataFrame, most_words: int) -> DataFrame:
    """Entries with a ``key`` each, no group of more than ``most_words`` by its beginning.

    The entries of a larger group go to groups by one more code point; and, as pairs whose first
    difference is right after the beginning are in no group together then, to ``gap`` groups
    of bodies that are equal but for that place: at most a word per letter.
    """
    group = ["side", "m", "depth", "key"]
    open_ = entries.withColumn("key", _key(F.col("depth")))
    done = None
    while True:
        large = open_.groupBy(*group).agg(F.count("*").alias("words")).where(F.col("words") > most_words).select(*group)
        large = store(large)
        if large.isEmpty():
            return open_.withColumn("gap", F.lit(False)) if done is None else done.unionByName(open_.withColumn("gap", F.lit(False)))
        small = open_.join(large, group, "left_anti").withColumn("gap", F.lit(False))
        wide = store(open_.join(large, group, "left_semi"))
        longer = F.char_length("body") == F.col("m")
        around = F.when(longer, F.concat(_key(F.col("depth")), F.substring("body", F.col("depth") + 2, F.col("m")))).otherwise(F.col("body"))
        gaps = wide.withColumn("key", around).withColumn("gap", F.lit(True))
        part = small.unionByName(gaps)
        done = part if done is None else done.unionByName(part)
        # Bodies that end here have no further code point; their partners are in the gap groups.
        deeper = wide.where(F.char_length("body") > F.col("depth")).withColumn("depth", F.col("depth") + 1)
        open_ = store(deeper.withColumn("key", _key(F.col("depth"))))


def _pairs_of_task(entries: pa.Table) -> pa.Table:
    """word, near, near_n in both directions for the groups of a task."""
    groups: dict[tuple, list[tuple[str, int]]] = defaultdict(list)
    columns = [entries.column(c).to_pylist() for c in ("side", "m", "depth", "key", "gap", "body", "n")]
    for side, m, depth, key, gap, body, n in zip(*columns):
        groups[side, m, depth, key, gap].append((body, n))
    acceptor = Acceptor()
    word: list[str] = []
    near: list[str] = []
    near_n: list[int] = []
    for (side, m, depth, key, gap), members in groups.items():
        if len(members) < 2:
            continue
        counts = dict(members)
        found = _gap_pairs(sorted(counts), m, depth) if gap else ((key + u, key + v) for u, v in acceptor.near_pairs(acceptor.add_group(sorted(b[depth:] for b in counts))))
        for a, b in found:
            # Two words of m - 1 code points meet in the group of that length.
            if len(b) < m:
                continue
            x, y = (a, b) if side == "head" else (a[::-1], b[::-1])
            # Pairs with an equal first half have met on side head.
            if side == "tail" and x[: m // 2] == y[: m // 2]:
                continue
            word += (x, y)
            near += (y, x)
            near_n += (counts[b], counts[a])
    return pa.table({"word": pa.array(word, pa.string()), "near": pa.array(near, pa.string()), "near_n": pa.array(near_n, pa.int64())})


def _gap_pairs(bodies: list[str], m: int, depth: int) -> Iterator[tuple[str, str]]:
    """Bodies that are equal around ``depth``: those of m code points differ there, a shorter one lacks it."""
    long = [b for b in bodies if len(b) == m]
    for at, a in enumerate(long):
        yield from ((a, b) for b in long[at + 1 :])
    for short in (b for b in bodies if len(b) < m):
        yield from ((short, b) for b in long if b[depth] != short[depth : depth + 1])


def near_words(words: DataFrame, most_words: int = MOST_WORDS, task_entries: int = TASK_ENTRIES) -> DataFrame:
    """word, near, near_n for every two words one edit apart, in both directions."""
    entries = store(_entries(words))
    tasks = partitions_for(entries.count(), task_entries, 1)
    dealt = _cut_large(entries, most_words).withColumn("task", F.pmod(F.xxhash64("side", "m", "depth", "key", "gap"), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(_pairs_of_task, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root for the words with a form, in (word, form); steps double from round to round."""
    at = store(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("from"), F.col("root").alias("to"))
        new = store(at.join(further, at["root"] == further["from"], "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")))
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, most_words: int = MOST_WORDS, task_entries: int = TASK_ENTRIES) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word that counts."""
    words = store(word_counts(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near_words(words, most_words, task_entries).groupBy("word").agg(F.count("*").alias("n_near"), best)
    frequent = -F.col("best.less") >= F.col("n") * FORM_TIMES
    found = store(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"),
            F.when(frequent, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_library(spark)
    found = spelling_variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
