"""A star schema and raw datasets derived from TPC-H-like Parquet tables.

They give the operators something to run on where no shop data is at hand.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.operators.cleaning import calendar_parts
from ordersight.plans.first_row import keep_first
from ordersight.star import StarSchema

MONEY = "decimal(10,2)"

# Columns of the tables; given, so no file is opened to plan a query.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def star_from_driver_tables(spark: SparkSession, folder: str) -> StarSchema:
    makers = {
        "dim_customers": _customers,
        "dim_products": _products,
        "dim_sellers": _sellers,
        "dim_date": _dates,
        "fact_orders": _orders,
        "fact_order_items": _items,
        "fact_order_payments": _payments,
        "fact_order_reviews": _reviews,
    }
    tables = {name: partial(make, spark, folder) for name, make in makers.items()}
    # Read from the footers; repeats are dropped later, so it is an upper bound.
    return StarSchema(line_bound=lambda: _read(spark, folder, "lineitem").count(), **tables)


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "nation").select("n_nationkey", F.lower("n_name").alias("nation"))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _read(spark, folder, "customer")
        .join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
            F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
            F.lower("c_mktsegment").alias("customer_city"),
            F.col("nation").alias("customer_state"),
        )
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 == 0, "unknown")
        .otherwise(F.lower("p_type"))
        .alias("product_category_name"),
        F.length("p_name").alias("product_name_length"),
        F.col("p_size").alias("product_weight_g"),
    )


def _sellers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _read(spark, folder, "supplier")
        .join(_nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
            F.col("nation").alias("seller_state"),
        )
    )


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("order_purchase_timestamp").alias("date_id")
    days = _orders(spark, folder).select(day).dropna().distinct()
    return days.select("date_id", *calendar_parts(F.col("date_id")))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    # (l_orderkey, l_linenumber) repeats; the first row in this order stays.
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    keys = ["l_orderkey", "l_linenumber"]
    lines = _read(spark, folder, "lineitem").select(*keys, *order)
    return keep_first(lines, keys, order).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast(MONEY).alias("freight_value"),
    )


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return (
        _read(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_returnflag")
        .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("payment_value"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3).alias("payment_sequential"),
            flag.alias("payment_type"),
            F.lit(1).alias("payment_installments"),
            "payment_value",
        )
    )


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    event, day = F.col("event_id"), F.col("ts").cast("date")
    return _read(spark, folder, "events").select(
        event.alias("review_id"),
        F.expr("event_id div 2").alias("order_id"),
        (1 + (event + F.expr("event_id div 7")) % 5).cast("int").alias("review_score"),
        day.alias("review_creation_date"),
        day.alias("review_answer_timestamp"),
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    status = (
        F.when(F.col("o_orderstatus") != "P", "delivered")
        .when(key % 10 == 0, "canceled")
        .when(key % 10 == 1, "unavailable")
        .otherwise("shipped")
    )
    travel = 2 + (key * 37) % 23 + F.when(key % 40 == 7, 60).otherwise(0)
    received = F.when(
        (F.col("o_orderstatus") != "P") & (key % 97 != 0), F.date_add(day, travel.cast("int"))
    )
    return _read(spark, folder, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        day.alias("order_purchase_timestamp"),
        F.date_add(day, (key % 2).cast("int")).alias("order_approved_at"),
        received.alias("order_delivered_customer_date"),
        F.date_add(day, (10 + key % 15).cast("int")).alias("order_estimated_delivery_date"),
    )


def seller_line_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per seller before repeats are dropped: an upper bound read from one column."""
    return (
        _read(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("seller_id"))
        .agg(F.count("*").alias("n"))
    )


# Raw datasets with faults: repeats (the lower ord came first), missing keys and values,
# padded upper-case text, numbers and dates that cannot be read. {name} is a table.
RAW_SQL = {
    "customers": """
SELECT CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR(20)) END AS customer_id,
 CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(c_custkey - c_custkey % 2 AS VARCHAR(20)) END AS customer_unique_id,
 CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR(10)) END AS customer_zip_code_prefix,
 concat(chr(9), ' ', c_mktsegment, ' ') AS customer_city,
 CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE concat(' ', n_name) END AS customer_state, 0 AS ord
 FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL SELECT CAST(c_custkey AS VARCHAR(20)), 'again', '99999', ' OTHER ', 'zz', 1 FROM {customer} WHERE c_custkey % 20 = 0
""",
    "products": """
SELECT CASE WHEN p_partkey % 401 = 7 THEN NULL ELSE CAST(p_partkey AS VARCHAR(20)) END AS product_id,
 CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS product_category_name,
 CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat(CAST(length(p_name) AS VARCHAR(10)), '.9') END AS product_name_length,
 CAST(length(p_brand) AS VARCHAR(10)) AS product_description_length,
 CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE '3' END AS product_photos_qty,
 CAST(p_size AS VARCHAR(10)) AS product_weight_g, '10' AS product_length_cm,
 CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE '20' END AS product_height_cm, '30.0' AS product_width_cm,
 p_partkey AS ord
 FROM {part}
UNION ALL SELECT CAST(p_partkey AS VARCHAR(20)), 'again', '1', '1', '1', '1', '1', '1', '1', 1000000000000 + p_partkey FROM {part} WHERE p_partkey % 20 = 0
""",
    "sellers": """
SELECT CAST(s_suppkey AS VARCHAR(20)) AS seller_id,
 CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR(10)) END AS seller_zip_code_prefix,
 concat(' ', s_name, chr(9)) AS seller_city,
 CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE concat(n_name, chr(9)) END AS seller_state, 0 AS ord
 FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL SELECT CAST(s_suppkey AS VARCHAR(20)), '99999', 'OTHER', 'ZZ', 1 FROM {supplier} WHERE s_suppkey % 3 = 0
""",
    "orders": """
SELECT CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR(20)) END AS order_id,
 CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END AS customer_id,
 CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
 CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN '2018-13-01' ELSE concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), ' 23:59:59') END AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) END AS order_approved_at,
 CASE WHEN o_orderkey % 19 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) + 2 AS VARCHAR(10)) END AS order_delivered_carrier_date,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 9 AS VARCHAR(10)) END AS order_delivered_customer_date,
 CAST(CAST(o_orderdate AS DATE) + 20 AS VARCHAR(10)) AS order_estimated_delivery_date, 0 AS ord
 FROM {orders}
UNION ALL SELECT CAST(o_orderkey AS VARCHAR(20)), '1', 'again', '2031-02-03 00:00:00', '2018-01-01', '2018-01-01', '2018-01-01', '2018-01-01', 1 FROM {orders} WHERE o_orderkey % 20 = 0
""",
    "order_items": """
SELECT CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR(20)) END AS order_id,
 CAST(l_linenumber AS VARCHAR(10)) AS order_item_id,
 CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR(20)) END AS product_id,
 CASE WHEN l_suppkey % 71 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR(20)) END AS seller_id,
 CASE WHEN l_partkey % 23 = 0 THEN 'bad' WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR(20)) END AS price,
 CASE WHEN l_suppkey % 31 = 0 THEN 'bad' ELSE CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR(20)) END AS freight_value,
 concat(lpad(CAST(l_partkey AS VARCHAR(20)), 12, '0'), lpad(CAST(l_suppkey AS VARCHAR(20)), 12, '0'),
  lpad(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR(20)), 12, '0'),
  lpad(CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR(20)), 12, '0')) AS ord
 FROM {lineitem}
""",
    "payments": """
SELECT CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR(20)) END AS order_id,
 '1' AS payment_sequential, lower(o_orderpriority) AS payment_type,
 CASE WHEN o_orderkey % 13 = 0 THEN 'bad' WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 12 AS VARCHAR(10)) END AS payment_installments,
 CASE WHEN o_orderkey % 17 = 0 THEN 'bad' WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR(20)) END AS payment_value,
 0 AS ord
 FROM {orders}
UNION ALL SELECT CAST(o_orderkey AS VARCHAR(20)), '1', 'again', '1', '1.00', 1 FROM {orders} WHERE o_orderkey % 20 = 0
""",
    "reviews": """
SELECT CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR(20)) END AS review_id,
 CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 5000 AS VARCHAR(20)) END AS order_id,
 CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE CAST(event_id % 7 AS VARCHAR(20)) END AS review_score,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS review_comment_title,
 CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS review_comment_message,
 CASE WHEN event_id % 17 = 0 THEN '2018-13-01' ELSE CAST(CAST(ts AS DATE) AS VARCHAR(20)) END AS review_creation_date,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat(CAST(CAST(ts AS DATE) AS VARCHAR(20)), ' 10:20:30') END AS review_answer_timestamp, 0 AS ord
 FROM {events}
UNION ALL SELECT CAST(event_id AS VARCHAR(20)), '1', '3', 'again', 'again', '2018-01-01', '2018-01-01', 1 FROM {events} WHERE event_id % 20 = 0
""",
}
RAW_ORDER = ["ord"]


def raw_from_driver_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven raw datasets; ``RAW_ORDER`` tells which of several rows came first."""
    return {name: raw_dataset(spark, folder, name) for name in RAW_SQL}


def raw_dataset(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = RAW_SQL[name]
    used = [table for table in SCHEMAS if "{" + table + "}" in text]
    return spark.sql(text, **{table: _read(spark, folder, table) for table in used})
