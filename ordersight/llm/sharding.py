"""Sharding by balanced label propagation; DataFrame operations only.

Documents with equal texts are linked. Every document starts in a shard by the hash
of its id. Rounds of joins then move linked documents towards the shard where most of
their group is, as far as that shard has free quota; a group too large for a shard goes on
to its next best shard. A group is held as one row per shard it is in, with the number of
its documents there, so a group of very many copies is at most as many rows as there
are shards.

Unlinked documents even out the sizes: they are cut into tiers by size, and each
tier, the largest documents first, is dealt along its running sum into what the shards still
lack. Running sums and slots are made of sums per bucket and a window within each
bucket, so no shard is gathered in one task.

Law ``bytes``: the sizes of the shards are nearly equal.

Defined cases: a null text has no bytes and counts as equal to an empty one;
rows with a null id and repeated rows are dealt like others; an empty table gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ordersight.llm.tables import partitions_for, table, text_bytes
from ordersight.plans.shared_store import store

SHARDS = 40
ROW_BYTES = 16
ROUNDS = 6
#: Share of a shard that linked documents may take, so that others can even it out.
LINKED_SHARE = 0.9
#: Least size of the documents of each tier.
TIERS = (16_384, 4_096, 1_024, 0)
BUCKET_ROWS = 20_000


def _fraction(*values: Column | str) -> Column:
    """A number from 0 to 1 that depends on the values alone."""
    return F.pmod(F.xxhash64(*values), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _linked_cells(rows: DataFrame) -> DataFrame:
    """(key, size, shard, n) of groups with more than one document."""
    cells = rows.groupBy("key", "size", "shard").agg(F.count("*").alias("n"))
    linked = cells.groupBy("key").agg(F.sum("n").alias("total")).where("total > 1").select("key")
    return cells.join(linked, "key")


def _loads(cells: DataFrame, shards: int) -> list[float]:
    found = {r.shard: float(r.bytes) for r in cells.groupBy("shard").agg(F.sum(F.col("n") * F.col("size")).alias("bytes")).collect()}
    return [found.get(s, 0.0) for s in range(shards)]


def propagate(cells: DataFrame, quota: float, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of moves towards the neighbours' shard within each shard's free quota."""
    spark = cells.sparkSession
    for step in range(rounds):
        loads = _loads(cells, shards)
        free = spark.createDataFrame([(s, max(quota - load, 0.0)) for s, load in enumerate(loads)], "target int, free double")
        tie = _fraction("key", "shard", F.lit(step))
        open_ = cells.join(F.broadcast(free), F.col("shard") == F.col("target")).where("free > 0")
        best = open_.groupBy("key").agg(F.max(F.struct("n", tie.alias("tie"), "target")).alias("best"))
        wish = (
            cells.withColumn("tie", tie)
            .join(best, "key")
            .where("shard != best.target and struct(n, tie) < struct(best.n, best.tie)")
            .select("key", "size", "shard", "n", F.col("best.target").alias("target"))
        )
        asked = {r.target: float(r.bytes) for r in wish.groupBy("target").agg(F.sum(F.col("n") * F.col("size")).alias("bytes")).collect()}
        if not asked:
            break
        shares = [(t, min(1.0, max(quota - loads[t], 0.0) / max(bytes_, 1.0))) for t, bytes_ in asked.items()]
        share = spark.createDataFrame(shares, "target int, share double")
        wanted = F.col("n") * F.col("share")
        moved = (
            wish.join(F.broadcast(share), "target")
            .withColumn("n", (F.floor(wanted) + (_fraction("key", "shard", F.lit(step), F.lit("move")) < wanted - F.floor(wanted)).cast("long")))
            .where("n > 0")
        )
        gone = moved.select("key", "size", "shard", (-F.col("n")).alias("n"))
        come = moved.select("key", "size", F.col("target").alias("shard"), "n")
        cells = store(
            cells.select("key", "size", "shard", "n").unionByName(gone).unionByName(come)
            .groupBy("key", "size", "shard").agg(F.sum("n").alias("n")).where("n > 0")
        )
    return cells


def _place_linked(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Every row with ``shard`` where its group is; null where it has no group."""
    total = F.aggregate("spread", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    # Stored, so that the join below stands alone and a key with very many rows can be split.
    spread = store(cells.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("spread")).withColumn("total", total))
    # A group in one shard goes there whole; a larger one by the fraction of its ids.
    at = _fraction("doc_id", F.lit("place")) * F.col("total")
    start = F.struct(F.lit(0).cast("long").alias("past"), F.lit(None).cast("int").alias("shard"))
    found = F.aggregate(
        "spread",
        start,
        lambda s, x: F.when(s["shard"].isNotNull() & (at < s["past"]), s).otherwise(
            F.struct((s["past"] + x["n"]).alias("past"), x["shard"].alias("shard"))
        ),
    )
    joined = rows.drop("shard").join(spread, "key", "left")
    return joined.withColumn("shard", F.when(F.col("spread").isNotNull(), found["shard"])).drop("spread", "total")


def _within_buckets(rows: DataFrame, group: str, amount: Column, buckets: int, name: str) -> DataFrame:
    """``name``: the sum of ``amount`` over the rows of the group before this one."""
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets)))
    sums = bucketed.groupBy(group, "bucket").agg(F.sum(amount).alias("part"))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(group, "bucket", F.coalesce(F.sum("part").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(group, "bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = bucketed.withColumn(name, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(base, [group, "bucket"]).withColumn(name, F.col(name) + F.col("base")).drop("base", "bucket")


def _deal(pool: DataFrame, loads: list[float], goal: float, buckets: int) -> DataFrame:
    """Shards for the rows of the pool, tier by tier, so that all come near ``goal``."""
    tier = reduce(lambda c, k: c.when(F.col("size") - ROW_BYTES >= TIERS[k], k), range(1, len(TIERS)), F.when(F.col("size") - ROW_BYTES >= TIERS[0], 0))
    running = store(_within_buckets(pool.withColumn("tier", tier), "tier", F.col("size"), buckets, "before"))
    totals = {r.tier: float(r.bytes) for r in running.groupBy("tier").agg(F.sum("size").alias("bytes")).collect()}
    dealt = []
    for k in range(len(TIERS)):
        if k not in totals:
            continue
        lack = [max(goal - load, 0.0) for load in loads]
        scale = totals[k] / sum(lack) if sum(lack) else 0.0
        edges, past = [], 0.0
        for missing in lack:
            past += missing * scale if sum(lack) else totals[k] / len(lack)
            edges.append(past)
        middle = F.col("before") + F.col("size") / 2
        shard = F.least(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= middle)), F.lit(len(loads) - 1))
        mine = running.where(F.col("tier") == k).withColumn("shard", shard.cast("int"))
        for r in mine.groupBy("shard").agg(F.sum("size").alias("bytes")).collect():
            loads[r.shard] += float(r.bytes)
        dealt.append(mine.drop("tier", "before"))
    return reduce(DataFrame.unionByName, dealt, pool.where("false").withColumn("shard", F.lit(0)))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (text_bytes(F.col("text")) + ROW_BYTES).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("key"),
            F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
        )
    )
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = partitions_for(count, BUCKET_ROWS, 64)
    goal = total / shards
    cells = store(_linked_cells(rows))
    linked = sum(_loads(cells, shards))
    cells = propagate(cells, goal * max(LINKED_SHARE, min(linked / max(total, 1), 1.0)), shards)
    placed = store(_place_linked(rows, cells))
    loads = _loads(placed.where("shard is not null").withColumn("n", F.lit(1)), shards)
    # What chance put over the goal is dealt anew with the unlinked.
    stay = F.array(*[F.lit(min(1.0, 0.98 * goal / load) if load > goal else 1.0) for load in loads])
    stays = F.col("shard").isNotNull() & (_fraction("doc_id", F.lit("stay")) < F.get(stay, F.col("shard")))
    kept, pool = placed.where(stays), placed.where(~F.coalesce(stays, F.lit(False))).drop("shard")
    loads = _loads(kept.withColumn("n", F.lit(1)), shards)
    whole = store(kept.unionByName(_deal(pool, loads, goal, buckets)))
    return _within_buckets(whole, "shard", F.lit(1), buckets, "slot").drop("key")


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_documents(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast(T.IntegerType()).alias("grown_shard")
    )
