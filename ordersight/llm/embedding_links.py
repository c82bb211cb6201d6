"""Near-duplicate embeddings by NN-descent.

Equal vectors become one with a count. The neighbour graph starts from random
hyperplane trees: vectors on the same side of all planes meet in a leaf. Rounds of
descent follow: around every vector its neighbours and those that name it meet, and
each keeps its best ``NEIGHBOURS``. An audit compares a bounded sample with all vectors;
while less than ``RECALL`` of its links are found and a round still helps, another
round with new trees follows. A second audit counts all links of the sample, beyond what lists hold,
in the result; if either ends below ``RECALL``, all pairs of vectors are compared in blocks instead. Links are the neighbours with a cosine, in double precision,
of at least ``LEAST``.

A list with nothing but links is saturated: there may be more. Such lists are
enlarged to their whole component and to all components with saturated lists whose balls are
near enough for a link; their vectors meet in pairs of blocks that count
links without listing them, and components with a link between them become one.

Leaves and neighbourhoods beyond ``GROUP`` vectors are split by hash, the best
candidates of a vector are merged within a task before they are shuffled, and blocks
have at most ``BLOCK`` vectors, so neither a frequent vector nor a large group gathers in
one task.

Defined cases: vectors that are null, empty, all zero or hold null or non-finite
numbers link with nothing and are kept, like those with a null id (whose component is
null); of different lengths the shorter counts as ended by zeros; repeated
rows are other vectors that link with each other.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm.components import components
from ordersight.llm.tables import partitions_for, table
from ordersight.plans.shared_store import store

LEAST = 0.9
NEIGHBOURS = 8
TREES = 8
LEAF = 128
GROUP = 256
BLOCK = 1024
AUDIT = 400
RECALL = 0.99
MOST_ROUNDS = 6

_log = logging.getLogger(__name__)
_LISTS = "id long, ids array<long>, cosines array<double>"


def _unit(blobs: list[bytes]) -> np.ndarray:
    """Vectors of length 1, in double precision, shorter ones ended by zeros."""
    sizes = {len(b) for b in blobs}
    if len(sizes) == 1:
        x = np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1).copy()
    else:
        x = np.zeros((len(blobs), max(sizes, default=8) // 8))
        for row, blob in zip(x, blobs):
            row[: len(blob) // 8] = np.frombuffer(blob, "<f8")
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vectors: DataFrame) -> DataFrame:
    """id, vector (packed doubles) of vectors that can link."""
    values = F.col("embedding").cast("array<double>")
    known = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("id"), values.alias("values"))
    finite = F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    known = known.where(F.col("values").isNotNull() & finite & F.exists("values", lambda x: x != 0))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("values")
            flat, ends = np.asarray(lists.flatten()), np.append(0, np.cumsum(np.asarray(lists.value_lengths())))
            blobs = [flat[a:b].astype("<f8").tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(blobs, pa.binary())], ["id", "vector"])

    return known.mapInArrow(packed, "id long, vector binary")


def best_lists(owner: np.ndarray, other: np.ndarray, cosine: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Per owner its ``size`` others of the largest cosine (ties: smallest id), without repeats; sorted by owner."""
    order = np.lexsort((other, -cosine, owner))
    owner, other, cosine = owner[order], other[order], cosine[order]
    same = np.lexsort((other, owner))
    repeat = np.zeros(len(owner), bool)
    repeat[same[1:]] = (owner[same[1:]] == owner[same[:-1]]) & (other[same[1:]] == other[same[:-1]])
    owner, other, cosine = owner[~repeat], other[~repeat], cosine[~repeat]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    top = rank < size
    return owner[top], other[top], cosine[top]


def _list_batch(owner: np.ndarray, other: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    ids, first = np.unique(owner, return_index=True)
    ends = pa.array(np.append(first, len(owner)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.ListArray.from_arrays(ends, pa.array(other)), pa.ListArray.from_arrays(ends, pa.array(cosine))], ["id", "ids", "cosines"]
    )


def _meet(groups: DataFrame) -> DataFrame:
    """Best lists of the vectors of each group (group, id, vector); one row a vector and batch."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in _then_none(batches):
            whole = pa.Table.from_batches([*rest, *([batch] if batch is not None else [])]) if rest or batch is not None else None
            if whole is None or whole.num_rows == 0:
                continue
            group = whole["group"].to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            if batch is not None:
                # The last group may go on in the next batch.
                rest = whole.slice(int(edges[-2])).to_batches()
                edges = edges[:-1]
            if len(edges) < 2:
                continue
            ids = whole["id"].to_numpy()[: edges[-1]]
            x = _unit(whole["vector"].slice(0, int(edges[-1])).to_pylist())
            found: list[tuple] = []
            for a, b in zip(edges, edges[1:]):
                if b - a < 2:
                    continue
                cosines = np.clip(x[a:b] @ x[a:b].T, -1, 1)
                np.fill_diagonal(cosines, -2)
                size = min(NEIGHBOURS, b - a - 1)
                top = np.argpartition(-cosines, size - 1, axis=1)[:, :size]
                owners = np.repeat(np.arange(b - a), size)
                found.append((ids[a:b][owners], ids[a:b][top.ravel()], cosines[owners, top.ravel()]))
            if found:
                owner, other, cosine = (np.concatenate(c) for c in zip(*found))
                some = owner != other
                yield _list_batch(*best_lists(owner[some], other[some], cosine[some], NEIGHBOURS))

    return groups.mapInArrow(meet, _LISTS)


def _then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _merged(lists: DataFrame) -> DataFrame:
    """One list of the best neighbours a vector."""
    pairs = F.flatten(F.collect_list(F.arrays_zip("cosines", "ids")))
    best = F.slice(F.reverse(F.array_sort(F.array_distinct("pairs"))), 1, NEIGHBOURS)
    joined = lists.groupBy("id").agg(pairs.alias("pairs")).select("id", best.alias("best"))
    return joined.select("id", F.col("best.ids").alias("ids"), F.col("best.cosines").alias("cosines"))


def _split(groups: DataFrame, seed: int) -> DataFrame:
    """Groups (name columns in ``key``, id) cut by hash to about ``GROUP`` vectors, as one number.

    Each group and seed cuts in another way, so that parts of one tight group meet.
    """
    sizes = groups.groupBy("key").agg(F.count("*").alias("n"))
    cut = F.pmod(F.xxhash64("id", "key", F.lit(seed)), F.ceil(F.col("n") / GROUP))
    return groups.join(sizes, "key").select(F.xxhash64("key", cut).alias("group"), *[c for c in groups.columns if c != "key"])


def _gathered(groups: DataFrame, parts: int) -> DataFrame:
    return groups.repartition(parts, "group").sortWithinPartitions("group")


def _leaves(vectors: DataFrame, dimension: int, count: int, seed: int, parts: int) -> DataFrame:
    """(group, id, vector) of ``TREES`` trees of random hyperplanes."""
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / LEAF))))
    planes = np.random.default_rng(seed).normal(size=(dimension, TREES * max(bits, 1)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("vector").to_pylist())
            sides = (x @ planes[: x.shape[1]] > 0).reshape(len(x), TREES, -1)
            for tree in range(TREES):
                leaf = [f"{tree}:".encode() + (np.packbits(s).tobytes() if bits else b"") for s in sides[:, tree]]
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.binary()), batch.column("id"), batch.column("vector")], ["key", "id", "vector"])

    return _gathered(_split(vectors.mapInArrow(assign, "key binary, id long, vector binary"), seed), parts)


def _neighbourhoods(lists: DataFrame, vectors: DataFrame, seed: int, parts: int) -> DataFrame:
    """(group, id, vector): around each vector its neighbours and those that name it."""
    forward = lists.select(F.col("id").alias("key"), F.explode("ids").alias("id"))
    back = forward.select(F.col("id").alias("key"), F.col("key").alias("id"))
    around = forward.unionByName(back).unionByName(lists.select(F.col("id").alias("key"), "id")).distinct()
    return _gathered(_split(around, seed).join(vectors, "id"), parts)


def _true_counts(vectors: DataFrame, least: float) -> DataFrame:
    """(id, n): all links of at most ``AUDIT`` of the vectors (id, vector, copies), by comparison with every vector."""
    spark = vectors.sparkSession
    chosen = vectors.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(AUDIT).collect()
    asked = spark.sparkContext.broadcast(([r.id for r in chosen], [bytes(r.vector) for r in chosen]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, blobs = asked.value
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _unit([*blobs, *batch.column("vector").to_pylist()])
                close = np.clip(x[: len(ids)] @ x[len(ids) :].T, -1, 1) >= least
                close &= np.array(ids)[:, None] != np.asarray(batch.column("id"))[None, :]
                total += close @ np.asarray(batch.column("copies"))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total)], ["id", "n"])

    return vectors.select("id", "vector", "copies").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _audit(lists: DataFrame, true: DataFrame, least: float) -> float:
    """Share of the links in ``true``, as far as lists can hold them, that was found."""
    found = lists.join(F.broadcast(true), "id").select(F.size(F.filter("cosines", lambda c: c >= least)).alias("found"), F.least("n", F.lit(NEIGHBOURS)).alias("n"))
    sums = found.agg(F.sum("found"), F.sum("n")).first()
    every = true.agg(F.sum(F.least("n", F.lit(NEIGHBOURS)))).first()[0] or 0
    return (sums[0] or 0) / every if every else 1.0


def _recall(totals: DataFrame, true: DataFrame) -> float:
    """Mean share of its links that a vector of ``true`` with links has in ``totals`` (id, n)."""
    shares = true.where("n > 0").join(totals.withColumnRenamed("n", "found"), "id", "left").select((F.coalesce("found", F.lit(0)) / F.col("n")).alias("share"))
    return shares.agg(F.coalesce(F.avg("share"), F.lit(1.0))).first()[0]


def neighbour_lists(vectors: DataFrame, least: float = LEAST) -> tuple[DataFrame, list[float]]:
    """(id, ids, cosines) and the audited recall after each round."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count, longest = vectors.agg(F.count("*"), F.max(F.length("vector"))).first()
    parts = partitions_for(count, 20_000, parts)
    dimension = (longest or 8) // 8
    true = store(_true_counts(vectors.withColumn("copies", F.lit(1).cast("long")), least))
    lists, recalls = None, []
    while len(recalls) < MOST_ROUNDS:
        fresh = _meet(_leaves(vectors, dimension, count, len(recalls), parts))
        lists = store(_merged(fresh if lists is None else fresh.unionByName(lists)))
        near = _meet(_neighbourhoods(lists, vectors, len(recalls), parts))
        lists = store(_merged(near.unionByName(lists)))
        recalls.append(_audit(lists, true, least))
        if recalls[-1] >= RECALL and (len(recalls) > 1 or recalls[-1] == 1.0):
            break
        if len(recalls) > 2 and recalls[-1] <= recalls[-3]:
            break
    return lists, recalls


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group, one after the other."""
    rest = None
    for batch in _then_none(batches):
        parts = [t for t in (rest, pa.Table.from_batches([batch]) if batch is not None else None) if t is not None and t.num_rows]
        if not parts:
            continue
        whole = pa.concat_tables(parts)
        group = whole["group"].to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        if batch is not None:
            # The last group may go on in the next batch.
            rest, edges = whole.slice(int(edges[-2])), edges[:-1]
        for a, b in zip(edges, edges[1:]):
            yield whole.slice(int(a), int(b - a))


def _near_components(members: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), a < b, of components that can have a link between them.

    A component lies in a ball around the vector of its smallest id. Angles obey the triangle
    inequality, so balls further apart than the angle of a link have none.
    """
    centres = members.where("id = component").select("component", F.col("vector").alias("centre"))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unit([*batch.column("vector").to_pylist(), *batch.column("centre").to_pylist()])
                cosines = (x[: batch.num_rows] * x[batch.num_rows :]).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("component"), pa.array(np.arccos(np.clip(cosines, -1, 1)))], ["component", "angle"])

    turned = members.join(centres, "component").select("component", "vector", "centre").mapInArrow(turn, "component long, angle double")
    balls = store(centres.join(turned.groupBy("component").agg(F.max("angle").alias("angle")), "component"))
    blocks = -(-balls.count() // BLOCK)
    dealt = balls.withColumn("block", F.pmod(F.xxhash64("component"), F.lit(blocks)))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))) if blocks else dealt.withColumn("other", F.col("block"))
    met = met.select(
        F.xxhash64(F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        "component", "centre", "angle", (F.col("block") <= F.col("other")).alias("first"), (F.col("block") >= F.col("other")).alias("second"),
    )
    # Beyond the rounding of an arc cosine near one.
    reach = float(np.arccos(least)) + 1e-6

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in _tables(batches):
            ids, angles, x = pair["component"].to_numpy(), pair["angle"].to_numpy(), _unit(pair["centre"].to_pylist())
            first, second = np.flatnonzero(pair["first"].to_numpy()), np.flatnonzero(pair["second"].to_numpy())
            apart = np.arccos(np.clip(x[first] @ x[second].T, -1, 1))
            i, j = np.nonzero(apart <= angles[first][:, None] + angles[second][None, :] + reach)
            one, other = ids[first[i]], ids[second[j]]
            some = one != other
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, other)[some]), pa.array(np.maximum(one, other)[some])], ["a", "b"])

    return met.repartition("group").sortWithinPartitions("group").mapInArrow(meet, "a long, b long").distinct()


def joined_ids(one: np.ndarray, other: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that the links ``close`` between two groups join each of them with, directly or not."""
    most = np.iinfo(np.int64).max
    while True:
        new_other = np.minimum(other, np.where(close, one[:, None], most).min(0, initial=most))
        new_one = np.minimum(one, np.where(close, new_other[None, :], most).min(1, initial=most))
        if (new_one == one).all() and (new_other == other).all():
            return one, other
        one, other = new_one, new_other


def _count_links(members: DataFrame, pairs: DataFrame, least: float, parts: int) -> DataFrame:
    """(id, n, joined): links of the vectors (component, id, vector, copies) of each pair (a, b, join) of components.

    Blocks of both components meet, or all pairs of blocks of one component. If ``join`` is set,
    ``joined`` is the smallest id that links of the two blocks join the vector with.
    """
    sizes = store(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    dealt = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("component").alias(side), F.col("blocks").alias(f"blocks_{side}")), side)
    ends = pairs.select(F.col("a").alias("component"), "a", "b", "join", F.lit(True).alias("left"), F.col("blocks_b").alias("others"))
    ends = ends.unionByName(pairs.where("a != b").select(F.col("b").alias("component"), "a", "b", "join", F.lit(False).alias("left"), F.col("blocks_a").alias("others")))
    met = dealt.join(ends, "component").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    own, left, block, other = F.col("a") == F.col("b"), F.col("left"), F.col("block"), F.col("other")
    # A block meets each other block once: as the first or the second of the two.
    low = F.when(own, F.least(block, other)).when(left, block).otherwise(other)
    high = F.when(own, F.greatest(block, other)).when(left, other).otherwise(block)
    met = met.select(
        F.xxhash64("a", "b", low, high).alias("group"), "id", "vector", "copies", "join",
        F.when(own, block <= other).otherwise(left).alias("first"), F.when(own, block >= other).otherwise(~left).alias("second"),
    )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in _tables(batches):
            ids, copies = pair["id"].to_numpy(), pair["copies"].to_numpy()
            first, second = pair["first"].to_numpy(), pair["second"].to_numpy()
            x = _unit(pair["vector"].to_pylist())
            close = np.clip(x[first] @ x[second].T, -1, 1) >= least
            close &= ids[first][:, None] != ids[second][None, :]
            if not close.any():
                continue
            n, joined = np.zeros(len(ids), np.int64), ids.copy()
            n[first] += close @ copies[second]
            if not (first & second).all():
                n[second] += copies[first] @ close
            if pair["join"][0].as_py():
                rows, columns = np.flatnonzero(close.any(1)), np.flatnonzero(close.any(0))
                one, other = np.flatnonzero(first)[rows], np.flatnonzero(second)[columns]
                low_one, low_other = joined_ids(ids[one], ids[other], close[np.ix_(rows, columns)])
                np.minimum.at(joined, one, low_one)
                np.minimum.at(joined, other, low_other)
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some]), pa.array(joined[some])], ["id", "n", "joined"])

    return _gathered(met, parts).mapInArrow(tally, "id long, n long, joined long")


def _links_of_lists(lists: DataFrame, same: DataFrame, least: float, parts: int) -> tuple[DataFrame, DataFrame]:
    """(id, n) and (id, component) of the linked vectors, from their lists and near components."""
    links = store(
        lists.select("id", F.explode(F.arrays_zip("ids", "cosines")).alias("x")).where(F.col("x.cosines") >= least).select(F.col("id").alias("a"), F.col("x.ids").alias("b"))
    )
    both = store(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    classes = components(links)
    full = lists.where((F.size("ids") == NEIGHBOURS) & (F.array_min("cosines") >= least)).select("id")
    # A vector that many name may have more links than its own list, so its whole component is counted.
    wide = store(classes.join(full, "id").select("component").distinct())
    members = store(classes.join(wide, "component").join(same, "id").select("component", "id", "vector", "copies"))
    # Saturated lists may have lost every link between two components, so near ones are compared too.
    pairs = wide.select(F.col("component").alias("a"), F.col("component").alias("b"), F.lit(False).alias("join"))
    pairs = store(pairs.unionByName(_near_components(members, least).withColumn("join", F.lit(True))))
    met = store(_count_links(members, pairs, least, parts))
    counted = met.groupBy("id").agg(F.sum("n").alias("n"))
    copies = same.select(F.col("id").alias("b"), "copies")
    few = both.join(copies, "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("n"))
    few = few.join(classes, "id").join(wide, "component", "left_anti").select("id", "n")
    totals = store(few.unionByName(counted))
    bridges = met.where("joined < id").select(F.col("id").alias("a"), F.col("joined").alias("b")).distinct()
    if not bridges.isEmpty():
        classes = components(bridges.unionByName(classes.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))))
    return totals, classes


def _all_links(same: DataFrame, least: float, parts: int) -> tuple[DataFrame, DataFrame]:
    """Exact (id, n) and (id, component) of the linked vectors: every block meets every other."""
    count = same.count()
    everything = F.lit(0).cast("long")
    pairs = same.sparkSession.range(1).select(everything.alias("a"), everything.alias("b"), F.lit(True).alias("join"))
    parts = partitions_for(count * -(-count // BLOCK), 50_000, parts)
    met = store(_count_links(same.select(everything.alias("component"), "id", "vector", "copies"), pairs, least, parts))
    return met.groupBy("id").agg(F.sum("n").alias("n")), components(met.select(F.col("id").alias("a"), F.col("joined").alias("b")))


def embedding_links(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usable = store(_usable(vectors))
    same = store(usable.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    lists, recalls = neighbour_lists(same.select("id", "vector"), least)
    exact = recalls[-1] < RECALL
    if not exact:
        totals, classes = _links_of_lists(lists, same, least, parts)
        recall = _recall(totals, _true_counts(same, least))
        exact = recall < RECALL
        _log.info("Audited recall of links: lists %.4f, all %.4f", recalls[-1], recall)
    if exact:
        _log.warning("Audited recall of links %.4f below %.2f: all pairs of vectors are compared", recall if recalls[-1] >= RECALL else recalls[-1], RECALL)
        totals, classes = _all_links(same, least, parts)
    each = same.join(totals, "id", "left").join(classes, "id", "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    found = usable.join(each, "vector").select("id", "n_links", "component_id")
    once = found.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    joined = vectors.select("vec_id").join(once, F.col("vec_id").cast("long") == F.col("id"), "left")
    component = F.coalesce("component_id", F.col("vec_id").cast("long"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id").cast("long") == component, F.lit(True)).alias("kept"),
    )


def op8_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links(table(spark, folder, "embeddings"))
