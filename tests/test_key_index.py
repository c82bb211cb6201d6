from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ordersight.sources import key_index
from ordersight.sources.key_index import KeyIndex
from ordersight.sources.star_tables import (
    StarHome,
    create_star,
    load_idempotent,
    read_star,
    rows_of_keys,
    table_files,
)
from tests.conftest import values


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Sellers of three loads with ranges that overlap in part; each load is one file with rows."""
    home = StarHome(str(tmp_path_factory.mktemp("sellers") / "star"))
    create_star(spark, home)
    for start in (0, 1000, 1500):
        ids = spark.range(start, start + 1000, 2).select(F.format_string("s%06d", "id").alias("seller_id"))
        load_idempotent(ids.coalesce(1), home, "dim_sellers")
    return home


def ids(spark, *numbers):
    return spark.createDataFrame([(f"s{n:06d}",) for n in numbers], "seller_id STRING")


def opened(spark, home, keys):
    paths = table_files(spark, home, "dim_sellers")
    found = KeyIndex(spark, home.root, "dim_sellers", "seller_id").may_hold(keys, paths)
    held = spark.read.parquet(*paths).select("seller_id", F.col("_metadata.file_path").alias("file"))
    first = {key_index.file_name(row.file): row.low for row in held.groupBy("file").agg(F.min("seller_id").alias("low")).collect()}
    return sorted(first[key_index.file_name(path)] for path in found)


def test_new_keys_open_no_file_and_old_ones_theirs(spark, loaded):
    assert opened(spark, loaded, ids(spark, 9000, 9001)) == []
    # Inside the ranges, but not stored.
    assert opened(spark, loaded, ids(spark, *range(1, 400, 20), *range(1001, 2000, 40))) == []
    assert opened(spark, loaded, ids(spark, 10, 20)) == ["s000000"]
    assert opened(spark, loaded, ids(spark, 1990, 9000)) == ["s001000"]
    assert len(opened(spark, loaded, ids(spark, 10, 1990, 2400))) == 3
    assert opened(spark, loaded, ids(spark).limit(0)) == []


def test_every_stored_key_is_found(spark, loaded):
    stored = read_star(spark, loaded).dim_sellers
    assert stored.count() == 1250 and stored.select("seller_id").distinct().count() == 1250
    for part in range(5):
        keys = stored.where(F.pmod(F.xxhash64("seller_id"), F.lit(5)) == part).select("seller_id")
        rows = rows_of_keys(spark, loaded, "dim_sellers", keys)
        assert rows.join(keys, "seller_id", "left_semi").count() == keys.count()


def test_too_many_files_or_pairs_open_the_whole_range(spark, loaded, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_PROBES", 1)
    assert opened(spark, loaded, ids(spark, 11, 13)) == ["s000000"]
    monkeypatch.setattr(key_index, "MOST_FILES", 0)
    assert len(opened(spark, loaded, ids(spark, 11, 2401))) == 3


def test_no_more_pairs_than_stored_keys(spark, loaded, monkeypatch):
    """A batch as large as the table is not looked up in every file; reading the files is linear."""
    many = spark.range(1, 2500, 2).select(F.format_string("s%06d", "id").alias("seller_id"))
    monkeypatch.setattr(key_index, "FEW_PROBES", 0, raising=False)
    assert len(opened(spark, loaded, many)) == 3
    assert opened(spark, loaded, ids(spark, 11, 13)) == []


def test_a_load_reads_only_files_that_may_hold_its_keys(spark, loaded):
    """Rows of a file that is not opened cannot be seen: its damage goes unnoticed."""
    lost = [p for p in table_files(spark, loaded, "dim_sellers") if spark.read.parquet(p).agg(F.min("seller_id")).first()[0] == "s000000"]
    assert len(lost) == 1
    rows = rows_of_keys(spark, loaded, "dim_sellers", ids(spark, 2400))
    assert lost[0] not in rows.inputFiles() and len(rows.inputFiles()) == 1
    load_idempotent(ids(spark, 2400, 2401, 7000), loaded, "dim_sellers")
    assert read_star(spark, loaded).dim_sellers.count() == 1252


def test_files_without_index_are_always_read(spark, loaded):
    spark.createDataFrame([("s500000", None, None, None)], read_star(spark, loaded).dim_sellers.schema).write.mode("append").parquet(loaded.path("dim_sellers"))
    # Not indexed by any load, yet its key is not loaded again.
    load_idempotent(ids(spark, 500_000, 500_001), loaded, "dim_sellers")
    found = read_star(spark, loaded).dim_sellers.where("seller_id >= 's400000'")
    assert sorted(values(found, "seller_id")) == [("s500000",), ("s500001",)]
    paths = table_files(spark, loaded, "dim_sellers")
    assert KeyIndex(spark, loaded.root, "dim_sellers", "seller_id").may_hold(ids(spark, 600_000), paths) == []


def test_dates_and_second_columns_are_indexed(spark, tmp_path):
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    days = [(date(2018, 1, 1) + timedelta(days=n),) for n in range(30)]
    load_idempotent(spark.createDataFrame(days, "date_id DATE").coalesce(1), home, "dim_date")
    index = KeyIndex(spark, home.root, "dim_date", "date_id")
    paths = table_files(spark, home, "dim_date")
    assert [(row.low, row.high) for row in index.files().values() if row.keys] == [(days[0][0], days[-1][0])]
    assert len(index.may_hold(spark.createDataFrame([days[3]], "d DATE"), paths)) == 1
    reviews = spark.createDataFrame([("r1", "o1"), ("r2", None)], "review_id STRING, order_id STRING")
    load_idempotent(reviews.coalesce(1), home, "fact_order_reviews")
    by_order = rows_of_keys(spark, home, "fact_order_reviews", spark.createDataFrame([("o1",)], "o STRING"), "order_id")
    assert values(by_order.where("order_id = 'o1'"), "review_id") == [("r1",)]
    with pytest.raises(ValueError, match="no index"):
        KeyIndex(spark, home.root, "fact_orders", "order_status")


def test_buckets_keep_working(spark, tmp_path):
    home = StarHome(str(tmp_path / "star"), database="shop_index", buckets=4)
    create_star(spark, home)
    for start in (0, 50):
        rows = spark.range(start, start + 100).select(F.format_string("o%04d", "id").alias("order_id"), F.lit(1).alias("payment_sequential"))
        load_idempotent(rows, home, "fact_order_payments")
    assert read_star(spark, home).fact_order_payments.count() == 150
    found = rows_of_keys(spark, home, "fact_order_payments", spark.createDataFrame([("o0003",)], "k STRING"))
    assert len(found.inputFiles()) == 1 and found.where("order_id = 'o0003'").count() == 1


def test_without_order_the_smallest_row_stays(spark, tmp_path):
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    for rows in ([("s", "9", "b"), ("s", "10", "c"), ("t", None, "x")], [("t", "1", "y")]):
        load_idempotent(spark.createDataFrame(rows, "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING"), home, "dim_sellers")
    assert sorted(values(read_star(spark, home).dim_sellers, "seller_id", "seller_city")) == [("s", "c"), ("t", "x")]


def test_filters_of_a_large_file_are_built_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "TASK_BLOCKS", 50, raising=False)
    monkeypatch.setattr(key_index, "RANGE_BLOCKS", 10, raising=False)
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    rows = spark.range(1000).select(F.format_string("s%06d", "id").alias("seller_id"))
    load_idempotent(rows.coalesce(1), home, "dim_sellers")
    index = KeyIndex(spark, home.root, "dim_sellers", "seller_id")
    stored = spark.read.parquet(index.filters)
    assert stored.columns == ["file", "block", "bits"] and stored.select("file").distinct().count() == 1
    assert stored.select("block").distinct().count() == stored.count() and len(stored.inputFiles()) > 1
    paths = table_files(spark, home, "dim_sellers")
    assert all(len(index.may_hold(ids(spark, n), paths)) == 1 for n in range(0, 1000, 111))
