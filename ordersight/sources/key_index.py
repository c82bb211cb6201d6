"""Which data files of a stored table may hold given keys.

For every data file and key column the index keeps the smallest and the largest key, and a Bloom
filter in blocks of 64 bits: a key chooses one block and six of its bits. The filters are rows of
(file, block, bits), built with one aggregate and probed with one join, so they grow and spread
with the table and nothing of them is broadcast.

Files without an index, such as those of a load that broke off before it wrote one, count as
files that may hold any key. A key that a filter lets through by chance (about one absent key in
10,000 for each file whose range it lies in) costs reading a file for nothing, never a wrong result.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ordersight.star import STAR_SCHEMAS

#: Fixed choice: columns that loads and refreshes look rows up by.
INDEXED = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_date": ["date_id"],
    "fact_orders": ["order_id", "customer_id"],
    "fact_order_items": ["order_id", "product_id"],
    "fact_order_payments": ["order_id"],
    "fact_order_reviews": ["review_id", "order_id"],
}
BITS_PER_KEY, BLOCK_BITS, BITS_SET = 32, 64, 6
#: Filter blocks that one task builds, and blocks of a file that always meet in one.
TASK_BLOCKS, RANGE_BLOCKS = 1 << 17, 1 << 14
#: Files in the range of a batch that are sent to all tasks, and pairs of key and file that are
#: looked up in filters; beyond either, all files in the range are read.
MOST_FILES, MOST_PROBES = 50_000, 2_000_000_000
#: Up to so many pairs are always looked up; more of them only while they are no more than the keys
#: stored in those files, as reading these is cheaper then and would find the keys in most files anyway.
FEW_PROBES = 100_000


def _folder(root: str, table: str, column: str, part: str) -> str:
    return f"{root}/_keys/{table}.{column}/{part}"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def file_name(uri: str) -> str:
    """A data file by its path alone; ``file:/x`` and ``file:///x`` name one file."""
    return unquote(urlsplit(uri).path)


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _mask(key: Column) -> Column:
    """Six bits of a block, cut from a second hash."""
    second = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for at in range(BITS_SET):
        # shiftleft takes its count from a column only in SQL; powers of two as longs do the same.
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(second, 8 * at).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")).cast("int"))
        mask = mask.bitwiseOR(bit)
    return mask


def _file_schema(table: str, column: str) -> StructType:
    kind = STAR_SCHEMAS[table][column].dataType
    plain = StructType.fromDDL("file STRING, keys BIGINT, blocks BIGINT")
    return StructType([*plain.fields, StructField("low", kind), StructField("high", kind)])


class KeyIndex:
    """The index of one table's column below the root of a star."""

    def __init__(self, spark: SparkSession, root: str, table: str, column: str):
        if column not in INDEXED[table]:
            raise ValueError(f"{table} has no index on {column}")
        self.spark, self.table, self.column = spark, table, column
        self.ranges, self.filters = (_folder(root, table, column, part) for part in ("ranges", "filters"))

    def files(self) -> dict[str, Row]:
        """By path, file, keys, blocks, low, high of every indexed file: a short row per file, as
        Spark's own listing of the table has."""
        if not _exists(self.spark, self.ranges):
            return {}
        rows = self.spark.read.schema(_file_schema(self.table, self.column)).parquet(self.ranges).collect()
        return {file_name(row.file): row for row in rows}

    def add(self, paths: list[str]) -> None:
        """Index new data files of the table; the ranges are written last, as they make it count."""
        read = self.spark.read.schema(STAR_SCHEMAS[self.table]).parquet(*paths)
        keys = read.select(F.col(self.column).alias("key"), F.col("_metadata.file_path").alias("file")).where("key IS NOT NULL")
        blocks = F.greatest(F.ceil(F.count("*") * BITS_PER_KEY / BLOCK_BITS), F.lit(1)).cast("long")
        found = keys.groupBy("file").agg(F.count("*").alias("keys"), blocks.alias("blocks"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        schema = _file_schema(self.table, self.column)
        if found:
            # Files by number: a path in every row would take most of the memory of these steps.
            numbered = [(at, row.file, row.blocks) for at, row in enumerate(found)]
            numbers = F.broadcast(self.spark.createDataFrame(numbered, "number INT, file STRING, blocks BIGINT"))
            block = _block(F.col("key"), F.col("blocks"))
            marks = keys.join(numbers, "file").select("number", block.alias("block"), _mask(F.col("key")).alias("mask"))
            # Blocks are dealt in ranges, as many as keep a task small, and those of a file lie side by
            # side, so that a probe reads the row groups of its files only.
            parts = -(-sum(row.blocks for row in found) // TASK_BLOCKS)
            dealt = marks.withColumn("range", F.expr(f"block div {RANGE_BLOCKS}")).repartition(parts, "number", "range")
            filters = dealt.groupBy("number", "range", "block").agg(F.bit_or("mask").alias("bits")).sortWithinPartitions("number", "block")
            filters.join(numbers, "number").select("file", "block", "bits").write.mode("append").parquet(self.filters)
        # A file without keys has no range; its row says that it need not be read.
        held = {file_name(row.file) for row in found}
        bare = [(path, 0, 1, None, None) for path in paths if file_name(path) not in held]
        self.spark.createDataFrame([*map(tuple, found), *bare], schema).coalesce(1).write.mode("append").parquet(self.ranges)

    def may_hold(self, keys: DataFrame, paths: list[str]) -> list[str]:
        """Those of the table's data files ``paths`` that may hold one of the ``keys`` (one column)."""
        known = self.files()
        unknown = [path for path in paths if file_name(path) not in known]
        ranged = [path for path in paths if file_name(path) in known and known[file_name(path)].keys]
        if not ranged:
            return unknown
        wanted = keys.select(F.col(keys.columns[0]).alias("key")).where("key IS NOT NULL")
        low, high, count = wanted.agg(F.min("key"), F.max("key"), F.count("*")).first()
        near = [path for path in ranged if count and known[file_name(path)].low <= high and known[file_name(path)].high >= low]
        stored = sum(known[file_name(path)].keys for path in near)
        if not near or len(near) > MOST_FILES or count * len(near) > min(MOST_PROBES, max(FEW_PROBES, stored)):
            return unknown + near
        ranges = self.spark.createDataFrame([known[file_name(path)] for path in near], _file_schema(self.table, self.column))
        pairs = wanted.join(F.broadcast(ranges), F.col("key").between(F.col("low"), F.col("high")))
        probes = pairs.select("file", _block(F.col("key"), F.col("blocks")).alias("block"), _mask(F.col("key")).alias("mask"))
        filters = self.spark.read.schema("file STRING, block BIGINT, bits BIGINT").parquet(self.filters)
        filters = filters.where(F.col("file").isin([known[file_name(path)].file for path in near]))
        hits = probes.join(filters, ["file", "block"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        found = {file_name(row.file) for row in hits.select("file").distinct().collect()}
        return unknown + [path for path in near if file_name(path) in found]


def index_new_files(spark: SparkSession, root: str, table: str, paths: list[str]) -> None:
    """Bring the indexes of a table up to its data files ``paths``."""
    for column in INDEXED[table]:
        index = KeyIndex(spark, root, table, column)
        known = index.files()
        fresh = [path for path in paths if file_name(path) not in known]
        if fresh:
            index.add(fresh)
