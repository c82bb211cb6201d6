"""The stored star schema: creating, reading and loading its tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.operators import cleaning
from ordersight.plans.first_row import keep_first
from ordersight.plans.shared_store import stored_while
from ordersight.sources.csv_files import write_clean
from ordersight.sources.key_index import INDEXED, KeyIndex, index_new_files
from ordersight.star import PRIMARY_KEYS, STAR_SCHEMAS, StarSchema

log = logging.getLogger(__name__)

# Tables whose rows per key have a fixed bound (one, or as many as a 16-bit line
# or payment number), so no bucket can grow with one key. Reviews per order and
# orders per customer have no bound and stay unbucketed on those keys; products stay
# unbucketed so that the lines of a best-selling one can be split when they meet it.
BUCKET_KEYS = {
    "dim_customers": "customer_id",
    "fact_orders": "order_id",
    "fact_order_items": "order_id",
    "fact_order_payments": "order_id",
}

# A batch of more than one row for so many stored ones is sorted together with their keys; before a
# smaller one only the stored keys that it names take part.
LARGE_BATCH = 4

# Rows of a file are sorted by this column, so a range filter skips row groups.
SORT_COLUMNS = {"fact_orders": "order_purchase_timestamp"}


@dataclass(frozen=True)
class StarHome:
    """Where the tables are kept: Parquet folders below ``root``.

    With ``database`` they are registered as tables of that database, and with
    ``buckets`` those in :data:`BUCKET_KEYS` are bucketed, so joins and sums by
    order need no shuffle of orders, items and payments. Choose ``buckets`` so
    that a bucket of the largest table fits the memory of a task.
    """

    root: str
    database: str | None = None
    buckets: int | None = None

    def __post_init__(self) -> None:
        if self.buckets and not self.database:
            raise ValueError("buckets need a database to be recorded in")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def bucket_key(self, table: str) -> str | None:
        return BUCKET_KEYS.get(table) if self.buckets else None


def create_star(spark: SparkSession, home: StarHome) -> StarSchema:
    """Create the tables that do not exist yet, typed and empty."""
    if home.database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {home.database}")
    for name, schema in STAR_SCHEMAS.items():
        if not home.database:
            spark.createDataFrame([], schema).write.mode("ignore").parquet(home.path(name))
            continue
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
        key = home.bucket_key(name)
        clustered = f"CLUSTERED BY ({key}) INTO {home.buckets} BUCKETS" if key else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {home.database}.{name} ({columns}) "
            f"USING parquet {clustered} LOCATION '{home.path(name)}'"
        )
    return read_star(spark, home)


def _read_table(spark: SparkSession, home: StarHome, name: str) -> DataFrame:
    if home.database:
        return spark.table(f"{home.database}.{name}")
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(home.path(name))


def _append(df: DataFrame, home: StarHome, name: str) -> None:
    key = home.bucket_key(name)
    if key:
        # One task per bucket, so a load adds one file to each.
        df = df.repartition(home.buckets, key)
    if name in SORT_COLUMNS:
        df = df.sortWithinPartitions(SORT_COLUMNS[name])
    if home.database:
        df.write.insertInto(f"{home.database}.{name}")
    else:
        df.write.mode("append").parquet(home.path(name))


def read_star(spark: SparkSession, home: StarHome) -> StarSchema:
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: _read_table(spark, home, name)

    return StarSchema(**{name: reader(name) for name in STAR_SCHEMAS})


def stored_star(spark: SparkSession, home: StarHome) -> StarSchema:
    """The tables of a home that was loaded before; a home without them is an error."""
    for name in STAR_SCHEMAS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home.path(name))
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            raise FileNotFoundError(f"{home.root} holds no table {name}; run etl first")
    # Tables that are there are only registered, so a new session finds them.
    return create_star(spark, home) if home.database else read_star(spark, home)


def store_star(star: StarSchema, home: StarHome) -> StarSchema:
    """Append whole tables, as they are, to a new home."""
    spark = star.fact_orders.sparkSession
    create_star(spark, home)
    for name, df in star.tables().items():
        _append(_typed(df, name), home, name)
        index_new_files(spark, home.root, name, table_files(spark, home, name))
    return read_star(spark, home)


def first_rows(
    batch: DataFrame, keys: list[str], order: list[str] | None = None, null_keys: str = "fail"
) -> DataFrame:
    """One row per key: the first in ``order``, or in that of the other columns.

    A row without a key fails the load, as a primary key would, or is left out
    with ``null_keys="drop"``.
    """
    first = keep_first(batch, keys, list(order or [c for c in batch.columns if c not in keys] or keys))
    return _with_keys(first, keys, null_keys)


def _with_keys(rows: DataFrame, keys: list[str], null_keys: str) -> DataFrame:
    if null_keys not in ("fail", "drop"):
        raise ValueError(f"unknown null_keys {null_keys!r}")
    if null_keys == "drop":
        return rows.dropna(subset=keys)
    return rows.withColumns(
        {
            key: F.when(F.col(key).isNotNull(), F.col(key)).otherwise(
                F.raise_error(F.lit(f"null in primary key column {key}"))
            )
            for key in keys
        }
    )


def absent_rows(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The ``rows`` (one per key) whose key ``existing`` does not hold."""
    # Only the stored keys that the rows name take part, so a small batch is sent to
    # the stored table rather than the table being shuffled.
    stored = existing.select(*keys).join(rows.select(*keys), keys, "left_semi")
    return rows.join(stored, keys, "left_anti").select(*rows.columns)


def new_rows(
    batch: DataFrame,
    existing: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    null_keys: str = "fail",
) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet, the first per key as in :func:`first_rows`."""
    return absent_rows(first_rows(batch, keys, order, null_keys), existing, keys)


def new_rows_sorted(
    batch: DataFrame,
    existing: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    null_keys: str = "fail",
) -> DataFrame:
    """As :func:`new_rows`, by one sort of batch and stored keys; for a batch that is not small beside them."""
    order = list(order or [c for c in batch.columns if c not in keys] or keys)
    stored = existing.select(*[(F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType)).alias(f.name) for f in batch.schema])
    both = stored.dropna(subset=keys).withColumn("_new", F.lit(False)).unionAll(batch.withColumn("_new", F.lit(True)))
    # A stored key comes first, so the first row of its key is not new.
    first = keep_first(both, keys, ["_new", *order]).where("_new").drop("_new")
    return _with_keys(first, keys, null_keys)


def _typed(df: DataFrame, table: str, extra: list[str] = ()) -> DataFrame:
    """The table's columns in order and type; those ``df`` lacks are NULL."""
    columns = [
        (F.col(field.name) if field.name in df.columns else F.lit(None))
        .cast(field.dataType)
        .alias(field.name)
        for field in STAR_SCHEMAS[table]
    ]
    return df.select(*columns, *extra)


def table_files(spark: SparkSession, home: StarHome, table: str) -> list[str]:
    """The data files of a stored table that hold rows or may hold them."""
    if home.database:
        spark.catalog.refreshTable(f"{home.database}.{table}")
    return sorted(_read_table(spark, home, table).inputFiles())


def files_of_keys(
    spark: SparkSession, home: StarHome, table: str, keys: DataFrame, column: str | None = None
) -> tuple[list[str], list[str]]:
    """(files of a stored table that may hold one of the ``keys`` of an indexed column, all its files)."""
    paths = table_files(spark, home, table)
    return KeyIndex(spark, home.root, table, column or INDEXED[table][0]).may_hold(keys, paths), paths


def read_files(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """Some data files of a stored table."""
    if not paths:
        return spark.createDataFrame([], STAR_SCHEMAS[table])
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(*paths)


def rows_of_keys(
    spark: SparkSession, home: StarHome, table: str, keys: DataFrame, column: str | None = None
) -> DataFrame:
    """The part of a stored table whose files may hold one of the ``keys`` of an indexed column.

    A table that has them in most of its files is read as a whole, so that its buckets still count.
    """
    found, paths = files_of_keys(spark, home, table, keys, column)
    if found and 2 * len(found) > len(paths):
        return _read_table(spark, home, table)
    return read_files(spark, table, found)


def load_idempotent(
    batch: DataFrame,
    home: StarHome,
    table: str,
    order: list[str] | None = None,
    null_keys: str = "fail",
) -> None:
    """Append the rows of ``batch`` that ``table`` does not hold; safe to repeat.

    ``batch`` needs the table's columns (missing ones load as NULL) and, if
    ``order`` is given, those columns to tell which of several rows with the
    same key came first; without it the smallest row of a key stays. The batch
    is computed once, and only those data files of the table are read that may
    hold one of its keys (:mod:`ordersight.sources.key_index`).
    """
    spark, keys = batch.sparkSession, PRIMARY_KEYS[table]
    names = STAR_SCHEMAS[table].names
    typed = _typed(batch, table, order or [])
    if read_files(spark, table, table_files(spark, home, table)).isEmpty():
        _append(first_rows(typed, keys, order, null_keys).select(names), home, table)
    elif home.bucket_key(table):
        # Stored rows are not shuffled, whatever the batch.
        with stored_while(first_rows(typed, keys, order, null_keys).select(names)) as rows:
            existing = rows_of_keys(spark, home, table, rows.select(INDEXED[table][0]))
            _append(absent_rows(rows, existing, keys), home, table)
    else:
        with stored_while(typed) as rows:
            existing = rows_of_keys(spark, home, table, rows.select(INDEXED[table][0]))
            # Counts are read from the footers.
            find = new_rows_sorted if rows.count() * LARGE_BATCH > existing.count() else new_rows
            _append(find(rows, existing, keys, order, null_keys).select(names), home, table)
    index_new_files(spark, home.root, table, table_files(spark, home, table))


# Dataset, snapshot name and table, in the order of the keys between them.
LOADS = [
    ("customers", "customers", "dim_customers"),
    ("products", "products", "dim_products"),
    ("sellers", "sellers", "dim_sellers"),
    ("dates", "dates", "dim_date"),
    ("orders", "orders", "fact_orders"),
    ("order_items", "order_items", "fact_order_items"),
    ("payments", "order_payments", "fact_order_payments"),
    ("reviews", "order_reviews", "fact_order_reviews"),
]

CLEANERS = {
    "customers": cleaning.clean_customers,
    "products": cleaning.clean_products,
    "sellers": cleaning.clean_sellers,
    "orders": cleaning.clean_orders,
    "order_items": cleaning.clean_order_items,
    "payments": cleaning.clean_order_payments,
    "reviews": cleaning.clean_reviews,
}


def _clean(
    dataset: str, raw: dict[str, DataFrame], order: list[str]
) -> DataFrame:
    if dataset == "dates":
        return cleaning.build_dim_date(raw["orders"])
    if dataset in cleaning.UNIQUE:
        return CLEANERS[dataset](raw[dataset], order)
    # Items and payments keep their repeats, and the columns that order them.
    return CLEANERS[dataset](raw[dataset])


def clean_star(raw: dict[str, DataFrame], order: list[str] = cleaning.FILE_ORDER) -> StarSchema:
    """The star the raw data would load into empty tables, without storing anything."""

    def maker(dataset: str, table: str) -> Callable[[], DataFrame]:
        def make() -> DataFrame:
            clean = _clean(dataset, raw, order)
            if dataset != "dates" and dataset not in cleaning.UNIQUE:
                clean = keep_first(clean, PRIMARY_KEYS[table], list(order))
            return _typed(clean, table)

        return make

    return StarSchema(**{table: maker(dataset, table) for dataset, _, table in LOADS})


def run_etl(
    raw: dict[str, DataFrame],
    home: StarHome,
    snapshots: str | None = None,
    snapshot_format: str = "csv",
    order: list[str] = cleaning.FILE_ORDER,
    null_keys: str = "fail",
) -> StarSchema:
    """Clean every raw dataset, save snapshots if asked, and load the star tables."""
    spark = next(iter(raw.values())).sparkSession
    create_star(spark, home)
    for dataset, snapshot, table in LOADS:
        if dataset == "dates":
            clean, seen = _clean(dataset, raw, order), None
        else:
            seen = cleaning.WatchedRows(raw[dataset], dataset, order)
            clean = _clean(dataset, {dataset: seen.rows}, order)
        load_order = [name for name in order if name in clean.columns]
        # A snapshot is one more use of it, so then the raw files are read and cleaned once too.
        with stored_while(clean) if snapshots else nullcontext(clean) as rows:
            if snapshots:
                write_clean(rows.drop(*load_order), snapshots, snapshot, snapshot_format)
            load_idempotent(rows, home, table, load_order or None, null_keys)
        if seen is not None:
            log.info("%s: %s raw rows, %s dropped without key", dataset, *seen.counts())
    return read_star(spark, home)
