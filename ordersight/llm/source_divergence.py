"""How far the sources of a language differ in their words (op11).

1. Documents of each (language, term) are counted exactly; terms in at least ``LEAST_DOCS``
   documents of a language are its kept terms.
2. Each language's terms are cut into shards by hash, and a task per shard builds a minimal
   perfect hash that stores its keys (``perfect_hash``).
3. The hashes are broadcast in blocks of at most ``BLOCK_BYTES``; in a pass over the documents
   per block every task raises dense slots per (language, source), and the sums of the tasks
   are added up. One block holds some millions of terms.
4. Shares are whole numbers, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), N the counts of
   all kept terms of the group and V their number, in decimal arithmetic. Distances of two
   sources are added up over tiles of sources and slots in numpy, so no pair of sources is
   listed for each term.

Null text, lang or source count as ''. Documents are rows: repeated rows count each, whatever
their ids. A text without terms counts as a document of its group. A group without kept terms
has the same share for each of them. Very long texts are cut nowhere. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ordersight.llm.byte_words import RangeHash, chunks, mix
from ordersight.llm.letter_runs import distinct, runs, strings, wide_letters
from ordersight.llm.perfect_hash import Shards, build
from ordersight.llm.tables import ship_library, table
from ordersight.plans.shared_store import store

LEAST_DOCS = 30
#: Ranks of part ``term`` that are kept.
TERM_RANKS = 50
#: Scale of a share, and what is added to each count.
SCALE, ADDED = 1_000_000_000, 5
#: Terms of a shard, and bytes of stored keys and bits broadcast at once.
SHARD_TERMS = 1 << 15
BLOCK_BYTES = 48 << 20
#: Texts are handled in chunks of so many bytes; dense slots a task holds before it hands on its counts.
TEXT_BYTES = 4 << 20
HELD_SLOTS = 4 << 20
#: Sources and slots of a tile.
TILE_SOURCES, TILE_SLOTS = 128, 1024


def _texts(docs: DataFrame) -> DataFrame:
    """lang, source and text without nulls; the columns have these names only."""
    return docs.select(*[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each value, the different values)."""
    coded = values.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, term, docs: how many documents of a chunk hold the term."""
    for batch in batches:
        langs, names = _codes(batch.column("lang"))
        for first, data, offsets in chunks(batch.column("text"), TEXT_BYTES):
            found = runs(data, offsets, wide_letters(data))
            if not len(found.starts):
                continue
            example, kind = distinct(found)
            held = np.unique(found.owners * len(example) + kind)
            pairs = langs[first + held // len(example)].astype(np.int64) * len(example) + held % len(example)
            pairs, docs = np.unique(pairs, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(pairs // len(example))), strings(found, example[pairs % len(example)]), pa.array(docs)],
                ["lang", "term", "docs"],
            )


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term of every term in at least ``least_docs`` documents of the language."""
    counted = _texts(docs).select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs long")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term")


def _hashes(terms: pa.Array) -> np.ndarray:
    """The hashes that ``letter_runs.runs`` gives these terms."""
    parts = [np.zeros(0, np.uint64)]
    for _, data, offsets in chunks(terms, TEXT_BYTES):
        parts.append(mix(RangeHash(data, lower=True).of(offsets[:-1], offsets[1:])))
    return np.concatenate(parts)


def _add_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = _hashes(batch.column("term"))
        shard = (mix(hashes) % batch.column("shards").to_numpy(zero_copy_only=False).astype(np.uint64)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("term"), pa.array(shard)], ["lang", "term", "shard"])


def _build_shard(terms: pa.Table) -> pa.Table:
    column = terms.column("term").combine_chunks()
    sizes, bits, order, left = build(_hashes(column))
    keys = column.take(pa.array(np.concatenate([order, left])))
    return pa.table(
        {
            "lang": terms.column("lang").slice(0, 1).combine_chunks().cast(pa.string()),
            "shard": terms.column("shard").slice(0, 1).combine_chunks().cast(pa.int32()),
            "n_keys": pa.array([len(keys)], pa.int64()),
            "n_bytes": pa.array([int(keys.nbytes) + 16 * len(keys) + 9 * len(bits)], pa.int64()),
            "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
            "bits": pa.array([bits.tobytes()], pa.binary()),
            "terms": pa.array([keys.to_pylist()], pa.list_(pa.string())),
        }
    )


def perfect_hash_shards(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """A row per shard: lang, shard, n_keys, n_bytes, sizes, bits, terms (in slot order), first_slot in its lang."""
    sizes = terms.groupBy(F.col("lang").alias("of_lang")).agg(F.ceil(F.count("*") / shard_terms).cast("int").alias("shards"))
    dealt = terms.join(sizes, terms["lang"] == sizes["of_lang"]).select("lang", "term", "shards")
    dealt = dealt.mapInArrow(_add_shard, "lang string, term string, shard int")
    built = dealt.groupBy("lang", "shard").applyInArrow(
        _build_shard, "lang string, shard int, n_keys long, n_bytes long, sizes array<long>, bits binary, terms array<string>"
    )
    # One row per shard from here on.
    earlier = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    built = store(built)
    starts = built.select("lang", "shard", F.coalesce(F.sum("n_keys").over(earlier), F.lit(0)).alias("first_slot"))
    return store(built.join(starts, ["lang", "shard"]))


class _Counter:
    """Counts the runs of documents in dense slots per group of (lang, source)."""

    def __init__(self, held: dict):
        self.held = held

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = self.held.value
        shards = Shards(block["sizes"], block["bits"], block["terms"])
        # Of every language: shards in all, number of its first shard in the block, the block's shards of it, slots.
        of_lang = {lang: at for at, lang in enumerate(block["langs"])}
        total, number = np.array(block["shards_in_all"], np.uint64), np.array(block["numbers"], np.int64)
        low, wide = np.array(block["first_slots"], np.int64), np.array(block["slots"], np.int64)
        within = np.array(block["first_in_lang"], np.int64)
        dense: dict[tuple[int, str], np.ndarray] = {}
        held = 0
        for batch in batches:
            langs, names = _codes(batch.column("lang"))
            sources, source_names = _codes(batch.column("source"))
            lang_at = np.array([of_lang.get(name, -1) for name in names.to_pylist()], np.int64)[langs]
            groups, group = np.unique(lang_at * (len(source_names) + 1) + sources, return_inverse=True)
            for first, data, offsets in chunks(batch.column("text"), TEXT_BYTES):
                found = runs(data, offsets, wide_letters(data))
                lang = lang_at[first + found.owners]
                at = np.flatnonzero(lang >= 0)
                if not len(at):
                    continue
                lang = lang[at]
                shard = (mix(found.hashes[at]) % total[lang]).astype(np.int64)
                # Where the shard lies in the block, -1 if in another block.
                place = block["places"][number[lang] + shard]
                at, lang, place = at[place >= 0], lang[place >= 0], place[place >= 0]
                slot = shards.find(found, at, place)
                keep = slot >= 0
                slot = slot[keep] + within[place[keep]]
                owner = group[first + found.owners[at[keep]]]
                by_group = np.argsort(owner, kind="stable")
                owner, slot = owner[by_group], slot[by_group]
                borders = np.flatnonzero(np.diff(owner, prepend=-1))
                for start, end in zip(borders, np.append(borders[1:], len(owner))):
                    key = int(groups[owner[start]])
                    of, source = key // (len(source_names) + 1), source_names[key % (len(source_names) + 1)].as_py()
                    if (of, source) not in dense:
                        if held + wide[of] > HELD_SLOTS and dense:
                            yield from self.rows(dense, block["langs"], low)
                            dense, held = {}, 0
                        dense[of, source] = np.zeros(wide[of], np.int64)
                        held += wide[of]
                    np.add.at(dense[of, source], slot[start:end], 1)
        yield from self.rows(dense, block["langs"], low)

    @staticmethod
    def rows(dense: dict, langs: list[str], low: np.ndarray) -> Iterator[pa.RecordBatch]:
        for (of, source), slots in dense.items():
            at = np.flatnonzero(slots)
            for some in np.array_split(at, -(-len(at) // 50_000) or 1):
                columns = [pa.array([langs[of]] * len(some), pa.string()), pa.array([source] * len(some), pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(some + low[of]), pa.array(slots[some])], ["lang", "source", "slot", "n"])


def _blocks(shards: DataFrame, block_bytes: int) -> Iterator[tuple[list[Row], pa.Table]]:
    """What is known of them, and the shards themselves, brought together for one broadcast each.

    What the driver knows of all shards is a row of numbers for each ``SHARD_TERMS`` terms.
    """
    known = shards.select("lang", "shard", "n_keys", "n_bytes", "first_slot").orderBy("lang", "shard").collect()
    start = 0
    while start < len(known):
        end, size = start, 0
        while end < len(known) and (end == start or size + known[end].n_bytes <= block_bytes):
            size += known[end].n_bytes
            end += 1
        part = known[start:end]
        first, last = [F.struct(F.lit(p.lang).alias("lang"), F.lit(p.shard).alias("shard")) for p in (part[0], part[-1])]
        inside = F.struct("lang", "shard").between(first, last)
        yield part, shards.where(inside).select("lang", "shard", "sizes", "bits", "terms").toArrow().sort_by([("lang", "ascending"), ("shard", "ascending")])
        start = end


def group_counts(docs: DataFrame, shards: DataFrame, shards_of: dict[str, int], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, slot, n: how often each kept term occurs in each group; zeros are left out."""
    spark, texts, results = docs.sparkSession, _texts(docs), []
    for part, rows in _blocks(shards, block_bytes):
        langs = list(dict.fromkeys(p.lang for p in part))
        numbers = np.cumsum([0, *[shards_of[lang] for lang in langs]])[:-1]
        places = np.full(sum(shards_of[lang] for lang in langs), -1, np.int64)
        first_slot = {lang: min(p.first_slot for p in part if p.lang == lang) for lang in langs}
        for at, p in enumerate(part):
            places[numbers[langs.index(p.lang)] + p.shard] = at
        held = spark.sparkContext.broadcast(
            {
                "langs": langs,
                "shards_in_all": [shards_of[lang] for lang in langs],
                "numbers": numbers.tolist(),
                "places": places,
                "first_slots": [first_slot[lang] for lang in langs],
                "slots": [sum(p.n_keys for p in part if p.lang == lang) for lang in langs],
                "first_in_lang": [p.first_slot - first_slot[p.lang] for p in part],
                "sizes": [np.array(sizes, np.int64) for sizes in rows.column("sizes").to_pylist()],
                "bits": [np.frombuffer(bits, np.uint8) for bits in rows.column("bits").to_pylist()],
                "terms": [keys.values for keys in rows.column("terms")],
            }
        )
        counted = texts.mapInArrow(_Counter(held), "lang string, source string, slot long, n long")
        results.append(store(counted.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))))
        held.unpersist()
    if not results:
        return spark.createDataFrame([], "lang string, source string, slot long, n long")
    total = results[0]
    for more in results[1:]:
        total = total.unionAll(more)
    return total


def _share(n: Column, whole: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (N + 5 V)), exact."""
    above = ((n + ADDED).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(11,0)")).cast("decimal(38,0)")
    below = (whole + terms * ADDED).cast("decimal(38,0)")
    return F.call_function("div", above, below).cast("long") + 1


def _tile_distances(rows: pa.Table) -> pa.Table:
    """Sums of |p - q| over the slots of a tile, for its pairs of sources.

    A row with place -1 names a source of the tile and the share of terms it does not hold.
    """
    sources, places = rows.column("source"), rows.column("place").to_numpy()
    blocks, shares = rows.column("block").to_numpy(), rows.column("p").to_numpy()
    one, two, width = rows.column("one")[0].as_py(), rows.column("two")[0].as_py(), rows.column("width")[0].as_py()
    number, names = _codes(sources)
    # By name: rows come in any order, and two sources are to be the same pair in every tile.
    by_name = pc.sort_indices(names).to_numpy()
    names, number = names.take(pa.array(by_name)), np.argsort(by_name)[number]
    marks = places < 0
    matrix = np.zeros((len(names), width), np.int64)
    matrix[number[marks]] = shares[marks][:, None]
    matrix[number[~marks], places[~marks]] = shares[~marks]
    block_of = np.zeros(len(names), np.int64)
    block_of[number[marks]] = blocks[marks]
    left, right = np.flatnonzero(block_of == one), np.flatnonzero(block_of == two)
    a, b, value = [], [], []
    for i in left:
        others = right[right > i] if one == two else right
        if len(others):
            a.append(np.full(len(others), i))
            b.append(others)
            value.append(np.abs(matrix[others] - matrix[i]).sum(axis=1))
    empty = np.zeros(0, np.int64)
    a, b, value = (np.concatenate([empty, *parts]) for parts in (a, b, value))
    lang = pa.array([rows.column("lang")[0].as_py()] * len(a), pa.string())
    names = names.cast(pa.string())
    return pa.table({"lang": lang, "a": names.take(pa.array(a)), "b": names.take(pa.array(b)), "value": pa.array(value)})


def _pair_distances(shares: DataFrame, groups: DataFrame, tile_sources: int, tile_slots: int) -> DataFrame:
    """lang, a, b, value for each two sources of a language, once."""
    many = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile_sources).cast("int").alias("source_blocks"))
    groups = groups.join(many, "lang").withColumn("block", F.pmod(F.xxhash64("source"), "source_blocks").cast("int"))
    last = F.expr(f"(terms - 1) div {tile_slots}")
    marks = groups.where("terms > 0").select(
        "lang", "source", "block", "source_blocks", "terms", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("slot_block"), F.lit(-1).cast("long").alias("place"), F.col("p0").alias("p")
    )
    held = shares.join(groups.select("lang", "source", "block", "source_blocks"), ["lang", "source"]).select(
        "lang", "source", "block", "source_blocks", "terms", F.expr(f"slot div {tile_slots}").alias("slot_block"), (F.col("slot") % tile_slots).alias("place"), "p"
    )
    width = F.least(F.lit(tile_slots).cast("long"), F.col("terms") - F.col("slot_block") * tile_slots)
    # A source meets the sources of its own block and of each other one.
    others = F.transform(F.sequence(F.lit(0), F.col("source_blocks") - 1), lambda o: F.struct(F.least("block", o).alias("one"), F.greatest("block", o).alias("two")))
    tiles = held.unionAll(marks).select("lang", "source", "block", "slot_block", "place", "p", width.alias("width"), F.explode(others).alias("tile")).select("*", "tile.one", "tile.two").drop("tile")
    sums = tiles.groupBy("lang", "slot_block", "one", "two").applyInArrow(_tile_distances, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    term_ranks: int = TERM_RANKS,
    shard_terms: int = SHARD_TERMS,
    block_bytes: int = BLOCK_BYTES,
    tile_sources: int = TILE_SOURCES,
    tile_slots: int = TILE_SLOTS,
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    terms = store(kept_terms(docs, least_docs))
    shards = perfect_hash_shards(terms, shard_terms)
    sizes = shards.groupBy("lang").agg(F.sum("n_keys").alias("terms"))
    # One number per language that has kept terms, as the shards themselves are dealt.
    shards_of = {row.lang: -(-row.terms // shard_terms) for row in sizes.collect()}
    counts = store(group_counts(docs, shards, shards_of, block_bytes))

    seen = _texts(docs).select("lang", "source").distinct()
    whole = counts.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    groups = seen.join(whole, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("terms", F.lit(0)).alias("terms")
    )
    least = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("whole"), F.greatest("terms", F.lit(1))))
    groups = store(groups.withColumn("p0", least))
    shares = store(counts.join(groups, ["lang", "source"]).select("lang", "source", "slot", _share(F.col("n"), F.col("whole"), F.col("terms")).alias("p"), "terms"))

    pairs = _pair_distances(shares, groups, tile_sources, tile_slots)
    both_ways = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))]
    pairs = pairs.select("lang", F.explode(F.array(*both_ways)).alias("pair"), "value").select("lang", "pair.*", "value")
    # Languages without kept terms: every distance is 0.
    bare = groups.where("terms = 0").select("lang", "source")
    pairs = pairs.unionAll(bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source != item").select("lang", "source", "item", F.lit(0).cast("long")))

    of_lang = groups.groupBy("lang").agg(F.sum("whole").alias("whole"), F.max("terms").alias("terms"))
    usual = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).join(of_lang, "lang").select("lang", "slot", _share(F.col("n"), F.col("whole"), F.col("terms")).alias("q"))
    names = shards.select("lang", "first_slot", F.posexplode("terms").alias("at", "item")).select("lang", (F.col("first_slot") + F.col("at")).alias("slot"), "item")
    above = shares.join(usual.join(names, ["lang", "slot"]), ["lang", "slot"]).where("p > q").select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = [
        rows.withColumn("rank", F.row_number().over(by_value)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        for part, rows in (("pair", pairs), ("term", above))
    ]
    return ranked[0].unionAll(ranked[1].where(F.col("rank") <= term_ranks))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_library(spark)
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
found AS (SELECT lang, source, doc, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM every JOIN sizes USING (lang)),
usual AS (SELECT lang, term, 1 + (1000000000 * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q FROM every JOIN sizes USING (lang) GROUP BY lang, term),
distances AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS place FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) FROM shares JOIN usual USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 50
"""
