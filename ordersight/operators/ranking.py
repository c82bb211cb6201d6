"""Products ranked within their category, and delivery times of sellers."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ordersight.functions import ratio, round_to, whole_percent
from ordersight.plans.hot_groups import MAX_GROUP_ROWS, add_previous, add_ranks
from ordersight.plans.per_order import order_products
from ordersight.star import StarSchema

# Labels of the reports.
IMPROVED = "✅ Mejoró"
WORSENED = "❌ Empeoró"
SAME = "➡️ Igual"
FIRST_ORDER = "Primera orden"
TREND_UP = "🟢 Tendencia positiva"
TREND_DOWN = "🔴 Tendencia negativa"
TREND_NONE = "🟡 Sin tendencia clara"


def _product_totals(star: StarSchema) -> DataFrame:
    """Exact sums per product; every line counts once per review of its order."""
    totals = (
        order_products(star)
        .groupBy("product_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("revenue").alias("revenue"),
            F.sum("line_rows").alias("line_rows"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("scored_rows").alias("scored_rows"),
            F.sum("review_rows").alias("total_reviews"),
        )
    )
    # The product table joins after the sums: one row per product on both sides.
    products = star.dim_products.select("product_id", "product_category_name")
    return totals.join(products, "product_id").select(
        "product_id",
        "product_category_name",
        "total_orders",
        "revenue",
        ratio(F.col("revenue"), F.col("line_rows")).alias("avg_price"),
        ratio(F.col("score_sum"), F.col("scored_rows")).alias("avg_score"),
        "total_reviews",
    )


def product_metrics(star: StarSchema) -> DataFrame:
    return _product_totals(star).select(
        "product_id",
        "product_category_name",
        "total_orders",
        F.col("revenue").cast("double").alias("total_revenue"),
        round_to(F.col("avg_price"), 2).alias("avg_price"),
        round_to(F.col("avg_score"), 2).alias("avg_review_score"),
        "total_reviews",
    )


def product_ranking(star: StarSchema, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Every product with its places by revenue, orders and satisfaction."""
    category_sizes = star.dim_products.groupBy("product_category_name").agg(F.count("*").alias("n"))
    ranked = add_ranks(
        _product_totals(star),
        group="product_category_name",
        unique="product_id",
        measures={
            "revenue": (F.col("revenue"), ["row", "rank", "dense"]),
            "orders": (F.col("total_orders"), ["rank"]),
            "satisfaction": (F.col("avg_score"), ["rank"]),
        },
        row_bounds=category_sizes,
        max_rows=max_group_rows,
    )
    return ranked.select(
        "product_id",
        "product_category_name",
        "total_orders",
        F.col("revenue").cast("double").alias("total_revenue"),
        round_to(F.col("avg_price"), 2).alias("avg_price"),
        round_to(F.col("avg_score"), 2).alias("avg_review_score"),
        F.col("revenue_rank").alias("rank_by_revenue"),
        F.col("revenue_dense").alias("dense_rank_by_revenue"),
        F.col("revenue_row").alias("row_number_by_revenue"),
        F.col("orders_rank").alias("rank_by_orders"),
        F.col("satisfaction_rank").alias("rank_by_satisfaction"),
        F.col("group_rows").alias("products_in_category"),
    ).orderBy(F.asc_nulls_last("product_category_name"), "row_number_by_revenue")


def top_products(star: StarSchema, n: int = 3) -> DataFrame:
    """Products on the first ``n`` places by revenue; equal revenue shares a place."""
    # Spark limits each category in the map tasks before it shuffles.
    by_revenue = Window.partitionBy("product_category_name").orderBy(F.desc("revenue"))
    return (
        _product_totals(star)
        .withColumn("position", F.dense_rank().over(by_revenue))
        .filter(F.col("position") <= n)
        .select(
            "product_category_name",
            "position",
            "product_id",
            "total_orders",
            F.col("revenue").cast("double").alias("total_revenue"),
            round_to(F.col("avg_score"), 2).alias("avg_review_score"),
        )
        .orderBy(F.asc_nulls_last("product_category_name"), "position", "product_id")
    )


def _deliveries(
    star: StarSchema, row_bounds: DataFrame | None, max_group_rows: int, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Delivered lines with the seller's delivery before them, and ``extra`` columns of their orders."""
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    delivered = star.fact_orders.filter(
        (F.col("order_status") == "delivered") & received.isNotNull()
    ).select(
        "order_id",
        "order_purchase_timestamp",
        F.datediff(received, bought).alias("delivery_days"),
        *extra,
    )
    items = star.fact_order_items.select("seller_id", "order_id", "order_item_id")
    # A day and the beginning of an order's id follow the order: a busy seller's day is many slices.
    text_ids = isinstance(star.fact_orders.schema["order_id"].dataType, StringType)
    ids = F.substring("order_id", 1, 2) if text_ids else F.shiftright("order_id", 20)
    if row_bounds is None:
        row_bounds = star.fact_order_items.groupBy("seller_id").agg(F.count("*").alias("n"))
    return add_previous(
        items.join(delivered, "order_id"),
        group="seller_id",
        order=["order_purchase_timestamp", "order_id", "order_item_id"],
        previous={
            "prev_delivery_days": "delivery_days",
            "prev_order_date": "order_purchase_timestamp",
        },
        row_bounds=row_bounds,
        max_rows=max_group_rows,
        slices=[F.col("order_purchase_timestamp"), ids],
    )


def seller_deliveries(
    star: StarSchema, row_bounds: DataFrame | None = None, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Each delivered order line with the seller's delivery before it.

    ``row_bounds`` (seller_id, n) may give known upper bounds of lines per
    seller; they are counted otherwise.
    """
    return _deliveries(star, row_bounds, max_group_rows, ("order_delivered_customer_date",)).select(
        "seller_id",
        "order_id",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "delivery_days",
        "prev_delivery_days",
        "prev_order_date",
    )


def seller_delivery_trend(
    star: StarSchema, row_bounds: DataFrame | None = None, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    days, before = F.col("delivery_days"), F.col("prev_delivery_days")
    trend = (
        F.when(days < before, IMPROVED)
        .when(days > before, WORSENED)
        .when(days == before, SAME)
        .otherwise(FIRST_ORDER)
    )
    return (
        _deliveries(star, row_bounds, max_group_rows)
        .filter(before.isNotNull())
        .orderBy("seller_id", "order_purchase_timestamp", "order_id", "order_item_id")
        .select(
            "seller_id",
            "order_id",
            "order_purchase_timestamp",
            "delivery_days",
            "prev_delivery_days",
            (days - before).alias("days_difference"),
            trend.alias("trend"),
        )
    )


def seller_trend_summary(
    star: StarSchema,
    min_deliveries: int = 10,
    share: str = "0.6",
    row_bounds: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Per seller: how often a delivery was faster or slower than the one before."""
    days, before = F.col("delivery_days"), F.col("prev_delivery_days")
    total, improved, worsened = F.col("total_deliveries"), F.col("improved"), F.col("worsened")
    most = total * F.lit(Decimal(share))
    return (
        _deliveries(star, row_bounds, max_group_rows)
        .filter(before.isNotNull())
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("total_deliveries"),
            round_to(ratio(F.sum(days), F.count(days)), 1).alias("avg_delivery_days"),
            F.count_if(days < before).alias("improved"),
            F.count_if(days > before).alias("worsened"),
        )
        .filter(total >= min_deliveries)
        .select(
            "*",
            (total - improved - worsened).alias("unchanged"),
            whole_percent(improved, total).alias("improvement_rate"),
            F.when(improved > most, TREND_UP)
            .when(worsened > most, TREND_DOWN)
            .otherwise(TREND_NONE)
            .alias("seller_trend"),
        )
        .orderBy("avg_delivery_days", "seller_id")
    )


def orders_in_range(star: StarSchema, first: date, last: date) -> DataFrame:
    """Orders bought from ``first`` to ``last``, both included."""
    return star.fact_orders.filter(
        F.col("order_purchase_timestamp").between(F.lit(first), F.lit(last))
    ).select("order_id", "order_purchase_timestamp", "order_status")


def product_revenue_since(star: StarSchema, since: date) -> DataFrame:
    """Revenue per product of all orders bought on or after ``since``."""
    orders = star.fact_orders.filter(F.col("order_purchase_timestamp") >= F.lit(since)).select("order_id")
    return (
        star.fact_order_items.select("order_id", "product_id", "price")
        .join(orders, "order_id")
        .groupBy("product_id")
        .agg(F.sum("price").cast("double").alias("total_revenue"))
    )
