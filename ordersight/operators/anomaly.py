"""Values far from the average, measured in standard deviations.

Global averages come from a one-row aggregate read as a scalar subquery, so no
window spans the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions import percent, ratio, round_to, whole_percent
from ordersight.plans.per_order import by_order, completed, payment_totals
from ordersight.star import StarSchema

# Labels of the reports.
PAYMENT_CRITICAL = "Crítico - revisar urgente"
PAYMENT_HIGH = "Anómalo alto"
PAYMENT_LOW = "Anómalo bajo"
SALES_DROP = "⚠️ Caída significativa"
DAY_PEAK = "Pico inusual - Posible campaña o error"
DAY_VALLEY = "Valle inusual - Posible problema operativo"
LATE_NEGATIVE = "🔴 Entrega tardía + reseña negativa"
LATE_NEUTRAL = "🟡 Entrega tardía + reseña neutral"
LATE_POSITIVE = "🟢 Entrega tardía pero reseña positiva"


def _with_z_score(df: DataFrame, value: str) -> DataFrame:
    """Add mean, deviation and z (NULL when all values are equal)."""
    stats = df.agg(
        F.struct(
            ratio(F.sum(value), F.count(value)).alias("mean"),
            F.stddev_samp(F.col(value).cast("double")).alias("deviation"),
        )
    ).scalar()
    measured = df.withColumn("stats", stats)
    mean, deviation = F.col("stats.mean"), F.col("stats.deviation")
    return measured.select(
        *df.columns,
        mean.alias("mean"),
        deviation.alias("deviation"),
        ratio(F.col(value).cast("double") - mean, deviation).alias("z"),
    )


def payment_outliers(star: StarSchema) -> DataFrame:
    totals = payment_totals(star).select("order_id", "paid")
    z = F.col("z")
    unusual = _with_z_score(totals, "paid").filter(F.abs(z) > 2)
    orders = star.fact_orders.select("order_id", "order_purchase_timestamp", "order_status")
    return (
        unusual.join(orders, "order_id")
        .orderBy(F.desc(F.abs(z)), "order_id")
        .select(
            "order_id",
            "order_purchase_timestamp",
            "order_status",
            F.col("paid").cast("double").alias("total_payment"),
            round_to(F.col("mean"), 2).alias("mean_payment"),
            round_to(F.col("deviation"), 2).alias("stddev_payment"),
            round_to(z, 2).alias("z_score"),
            F.when(z > 3, PAYMENT_CRITICAL)
            .when(z > 2, PAYMENT_HIGH)
            .when(z < -2, PAYMENT_LOW)
            .alias("anomaly_type"),
        )
    )


def _weekly_totals(star: StarSchema) -> DataFrame:
    """Product, category, week, orders_count and revenue (exact) of completed orders."""
    week = F.trunc("order_purchase_timestamp", "week")
    orders = completed(star.fact_orders).select("order_id", week.alias("week_start"))
    # A product counts once per order; the join already gathered each order.
    order_products = (
        orders.join(by_order(star, star.fact_order_items.select("order_id", "product_id", "price")), "order_id")
        .groupBy("order_id", "product_id", "week_start")
        .agg(F.sum("price").alias("price_sum"))
    )
    by_week = order_products.groupBy("product_id", "week_start").agg(
        F.count("*").alias("orders_count"), F.sum("price_sum").alias("revenue")
    )
    products = star.dim_products.select("product_id", "product_category_name")
    return by_week.join(products, "product_id").select(
        "product_id", "product_category_name", "week_start", "orders_count", "revenue"
    )


def weekly_sales(star: StarSchema) -> DataFrame:
    """Orders and revenue per product and week (Monday)."""
    return _weekly_totals(star).withColumn("revenue", F.col("revenue").cast("double"))


def weekly_sales_drop(star: StarSchema, max_pct: int = -30, min_prev: int = 5) -> DataFrame:
    """Weeks whose orders fell below the product's previous week with sales.

    The change in orders is cut to a whole percentage before it is compared.
    """
    # A product has at most one row per week, so its window is short.
    by_week = Window.partitionBy("product_id").orderBy(F.asc_nulls_last("week_start"))
    change = F.col("orders_count") - F.col("prev_week_orders")
    growth = F.col("revenue") - F.col("prev_week_revenue")
    return (
        _weekly_totals(star)
        .withColumn("prev_week_orders", F.lag("orders_count").over(by_week))
        .withColumn("prev_week_revenue", F.lag("revenue").over(by_week))
        .filter(F.col("prev_week_orders").isNotNull())
        .withColumn("orders_pct_change", whole_percent(change, F.col("prev_week_orders")))
        .filter((F.col("orders_pct_change") < max_pct) & (F.col("prev_week_orders") >= min_prev))
        .select(
            "product_id",
            "product_category_name",
            "week_start",
            "prev_week_orders",
            "orders_count",
            "orders_pct_change",
            F.col("prev_week_revenue").cast("double").alias("prev_week_revenue"),
            F.col("revenue").cast("double").alias("revenue"),
            percent(growth, F.col("prev_week_revenue")).alias("revenue_pct_change"),
            F.lit(SALES_DROP).alias("flag"),
        )
        .orderBy("orders_pct_change", "product_id", "week_start")
    )


def daily_volume_outliers(star: StarSchema) -> DataFrame:
    days = (
        completed(star.fact_orders)
        .groupBy("order_purchase_timestamp")
        .agg(F.count("*").alias("daily_count"))
    )
    z = F.col("z")
    return (
        _with_z_score(days, "daily_count")
        .filter(F.abs(z) > 2)
        .orderBy(F.desc(z), "order_purchase_timestamp")
        .select(
            "order_purchase_timestamp",
            "daily_count",
            round_to(F.col("mean"), 2).alias("mean_daily"),
            round_to(F.col("deviation"), 2).alias("stddev_daily"),
            round_to(z, 2).alias("z_score"),
            F.when(z > 2, DAY_PEAK).when(z < -2, DAY_VALLEY).alias("anomaly_label"),
        )
    )


def late_deliveries(star: StarSchema) -> DataFrame:
    """Very slow deliveries, once per review of the order or once without review."""
    bought = F.col("order_purchase_timestamp")
    delivered = (
        star.fact_orders.filter(
            (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
        )
        .select(
            "order_id",
            "order_purchase_timestamp",
            F.datediff("order_delivered_customer_date", bought).alias("actual_days"),
            F.datediff("order_estimated_delivery_date", bought).alias("estimated_days"),
        )
    )
    late = _with_z_score(delivered, "actual_days").filter(F.col("z") > 2)
    # Reviews are counted by order and score first (a handful of scores an order), so
    # an order with very many reviews joins as a few rows and is repeated afterwards.
    reviews = star.fact_order_reviews.groupBy("order_id", "review_score").agg(F.count("*").alias("times"))
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("times", F.lit(1))))
    score = F.col("review_score")
    return (
        late.join(reviews, "order_id", "left")
        .withColumn("copy", repeated)
        .orderBy(F.desc("z"), "order_id", F.asc_nulls_last("review_score"))
        .select(
            "order_id",
            "order_purchase_timestamp",
            "actual_days",
            "estimated_days",
            (F.col("actual_days") - F.col("estimated_days")).alias("delay_days"),
            round_to(F.col("z"), 2).alias("z_score"),
            "review_score",
            F.when(score <= 2, LATE_NEGATIVE)
            .when(score == 3, LATE_NEUTRAL)
            .otherwise(LATE_POSITIVE)
            .alias("impact_label"),
        )
    )


def product_week_zscore(star: StarSchema, limit: float = 2.0) -> DataFrame:
    """Weeks in which a product sold unusually against its own average."""
    # At most one row per product and week.
    by_product = Window.partitionBy("product_id")
    count: Column = F.col("orders_count")
    z = F.col("z")
    return (
        _weekly_totals(star)
        .withColumn("mean", ratio(F.sum(count).over(by_product), F.count(count).over(by_product)))
        .withColumn("deviation", F.stddev_samp(count.cast("double")).over(by_product))
        .withColumn("z", ratio(count.cast("double") - F.col("mean"), F.col("deviation")))
        .filter(F.abs(z) > limit)
        .orderBy(F.desc(F.abs(z)), "product_id", "week_start")
        .select(
            "product_id",
            "product_category_name",
            "week_start",
            "orders_count",
            round_to(F.col("mean"), 2).alias("mean_orders"),
            round_to(F.col("deviation"), 2).alias("stddev_orders"),
            round_to(z, 2).alias("z_score"),
        )
    )
