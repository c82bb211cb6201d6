"""Facts brought to one row per order before they are joined.

Items, payments and reviews all hang off an order, so joining them row by row
multiplies rows. Sums and averages over that product follow from per-order
counts, which keep every join one-to-one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.star import StarSchema

# Statuses of orders that were not completed.
NOT_COMPLETED = ("canceled", "unavailable")

#: Order lines that a task joins and sums at once, about 450 bytes each with their hash tables.
TASK_LINES = 400_000


def completed(orders: DataFrame, excluded: tuple[str, ...] = NOT_COMPLETED) -> DataFrame:
    return orders.filter(~F.col("order_status").isin(*excluded))


def by_order(star: StarSchema, df: DataFrame, task_lines: int = TASK_LINES) -> DataFrame:
    """``df`` dealt by order_id, so that a task joins and sums about ``task_lines`` order lines.

    Adaptive execution puts partitions together up to a size in compressed bytes; lines of an order or of
    orders with near ids take some thirty times that in memory. Joins and sums by order_id that follow keep
    the partitions. Tables of few lines, and those of a star that does not count its lines, are left alone.
    """
    spark = df.sparkSession
    tasks = -(-star.line_bound() // task_lines) if star.line_bound else 0
    if tasks <= spark.sparkContext.defaultParallelism:
        return df
    # Not fewer than the other side of a join has, which would be dealt again otherwise.
    return df.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "order_id")


def payment_totals(star: StarSchema) -> DataFrame:
    """order_id, paid (sum), payment_rows, valued_rows (payments with a value)."""
    if star.payment_totals is not None:
        return star.payment_totals
    return star.fact_order_payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("paid"),
        F.count("*").alias("payment_rows"),
        F.count("payment_value").alias("valued_rows"),
    )


def review_totals(star: StarSchema) -> DataFrame:
    """order_id, review_rows, scored_rows, score_sum."""
    return star.fact_order_reviews.groupBy("order_id").agg(
        F.count("*").alias("review_rows"),
        F.count("review_score").alias("scored_rows"),
        F.sum("review_score").alias("score_sum"),
    )


def copies(rows: Column) -> Column:
    """How often a left join repeats a row that meets ``rows`` partners."""
    return F.greatest(F.coalesce(rows, F.lit(0)), F.lit(1)).cast("bigint")


def order_products(star: StarSchema) -> DataFrame:
    """Completed orders by product, as if each line met each review of its order.

    order_id, product_id, revenue, line_rows (lines times reviews), score_sum,
    scored_rows, review_rows (reviews of the order).
    """
    lines = (
        completed(star.fact_orders)
        .select("order_id")
        .join(by_order(star, star.fact_order_items.select("order_id", "product_id", "price")), "order_id")
        .groupBy("order_id", "product_id")
        .agg(F.count("*").alias("lines"), F.sum("price").alias("price_sum"))
    )
    times = copies(F.col("review_rows"))
    return lines.join(review_totals(star), "order_id", "left").select(
        "order_id",
        "product_id",
        (F.col("price_sum") * times.cast("decimal(15,0)")).cast("decimal(38,2)").alias("revenue"),
        (F.col("lines") * times).alias("line_rows"),
        (F.col("lines") * F.coalesce("score_sum", F.lit(0))).alias("score_sum"),
        (F.col("lines") * F.coalesce("scored_rows", F.lit(0))).alias("scored_rows"),
        F.coalesce("review_rows", F.lit(0)).alias("review_rows"),
    )
