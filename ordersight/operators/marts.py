"""The five KPI tables of the dashboard."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions import percent, ratio, round_to
from ordersight.operators.rfm import rfm_scored, segment, share_of_all
from ordersight.plans.per_order import (
    completed,
    copies,
    order_products,
    payment_totals,
    review_totals,
)
from ordersight.star import StarSchema


def _money(amount: Column) -> Column:
    """An exact amount (two decimals) as a double."""
    return amount.cast("double")


KPI_SUMS = ["orders", "paid", "valued_rows", "rows", "canceled_rows", "delivered_rows", "on_time_rows", "score_sum", "scored_rows"]


def counted_orders(star: StarSchema, with_pairs: bool = False) -> DataFrame:
    """Orders with lines and payments, and what the general KPIs need of each.

    ``with_pairs`` adds the different (seller_id, product_id) of an order's lines, at most as many as its lines.
    """
    pair = [F.collect_set(F.struct("seller_id", "product_id")).alias("pairs")] if with_pairs else []
    items = star.fact_order_items.groupBy("order_id").agg(F.count("*").alias("item_rows"), *pair)
    return (
        star.fact_orders.select(
            "order_id",
            "customer_id",
            (F.col("order_status") == "canceled").alias("canceled"),
            F.col("order_delivered_customer_date").isNotNull().alias("delivered"),
            (
                F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
            ).alias("on_time"),
        )
        .join(items, "order_id")
        .join(payment_totals(star), "order_id")
        .join(review_totals(star), "order_id", "left")
    )


def kpi_sums() -> dict[str, Column]:
    """What a counted order adds to the general KPIs: it weighs items x payments x reviews."""
    pairs = F.col("item_rows") * copies(F.col("review_rows"))
    rows = pairs * F.col("payment_rows")
    scored = F.col("item_rows") * F.col("payment_rows")
    return {
        "orders": F.lit(1).cast("bigint"),
        "paid": (F.col("paid") * pairs.cast("decimal(15,0)")).cast("decimal(38,2)"),
        "valued_rows": F.col("valued_rows") * pairs,
        "rows": rows,
        "canceled_rows": F.when(F.col("canceled"), rows).otherwise(0),
        "delivered_rows": F.when(F.col("delivered"), rows).otherwise(0),
        "on_time_rows": F.when(F.col("on_time"), rows).otherwise(0),
        "score_sum": F.col("score_sum") * scored,
        "scored_rows": F.col("scored_rows") * scored,
    }


def person_kpis(star: StarSchema) -> DataFrame:
    """Per customer_unique_id the sums behind the general KPIs."""
    # Sum by account, then by person: unique customers are then a plain count.
    by_account = counted_orders(star).groupBy("customer_id").agg(*[F.sum(value).alias(name) for name, value in kpi_sums().items()])
    accounts = star.dim_customers.select("customer_id", "customer_unique_id")
    return (
        by_account.join(accounts, "customer_id")
        .groupBy("customer_unique_id")
        .agg(*[F.sum(name).alias(name) for name in KPI_SUMS])
    )


def seller_products(star: StarSchema) -> DataFrame:
    """seller_id, product_id and their lines in the orders the general KPIs count."""
    counted = (
        star.fact_orders.select("order_id", "customer_id")
        .join(star.dim_customers.select("customer_id"), "customer_id", "left_semi")
        .join(payment_totals(star), "order_id", "left_semi")
    )
    return (
        star.fact_order_items.select("order_id", "seller_id", "product_id")
        .join(counted, "order_id", "left_semi")
        .groupBy("seller_id", "product_id")
        .agg(F.count("*").alias("lines"))
    )


def kpi_general(star: StarSchema) -> DataFrame:
    """One row over orders joined with items, payments and reviews.

    Amounts, rates and averages weigh an order by items x payments x reviews,
    as that join does; the rows themselves are never built.
    """
    orders = counted_orders(star, with_pairs=True)
    accounts = star.dim_customers.select("customer_id", "customer_unique_id")
    orders = orders.join(accounts, "customer_id")
    # Each order gives a row of sums and a row per pair of seller and product, and both are
    # gathered in one aggregate: every fact is read once.
    sums = kpi_sums()
    person = F.struct(F.lit(True).alias("person"), F.col("customer_unique_id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"), *[sums[name].alias(name) for name in KPI_SUMS])
    nothing = [F.lit(None).cast(orders.select(sums[name]).schema[0].dataType).alias(name) for name in KPI_SUMS]
    pairs = F.transform("pairs", lambda pair: F.struct(F.lit(False).alias("person"), pair["seller_id"].cast("string").alias("a"), pair["product_id"].cast("string").alias("b"), *nothing))
    rows = orders.select(F.inline(F.concat(F.array(person), pairs)))
    found = rows.groupBy("person", "a", "b").agg(*[F.sum(name).alias(name) for name in KPI_SUMS])
    totals = found.agg(
        *[F.sum(name).alias(name) for name in KPI_SUMS],
        F.count(F.when(F.col("person"), F.col("a"))).alias("people"),
        F.count_distinct(F.when(~F.col("person"), F.col("a"))).alias("sellers"),
        F.count_distinct(F.when(~F.col("person"), F.col("b"))).alias("products"),
    )
    return _kpi_rates(totals)


def kpi_general_of(people: DataFrame, pairs: DataFrame) -> DataFrame:
    """:func:`kpi_general` from its sums per person and the pairs of seller and product."""
    totals = people.agg(F.count("customer_unique_id").alias("people"), *[F.sum(name).alias(name) for name in KPI_SUMS])
    active = pairs.agg(
        F.struct(
            F.count_distinct("seller_id").alias("sellers"),
            F.count_distinct("product_id").alias("products"),
        )
    ).scalar()
    return _kpi_rates(totals.withColumn("active", active).select("*", "active.*"))


def _kpi_rates(totals: DataFrame) -> DataFrame:
    """The general KPIs from one row of sums and counts."""
    paid = _money(F.col("paid"))
    return totals.select(
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.col("people").alias("unique_customers"),
        F.col("sellers").alias("active_sellers"),
        F.col("products").alias("products_sold"),
        paid.alias("total_revenue"),
        round_to(ratio(paid, F.col("valued_rows")), 2).alias("avg_order_value"),
        round_to(ratio(paid, F.col("people")), 2).alias("revenue_per_customer"),
        percent(F.col("on_time_rows"), F.col("delivered_rows")).alias("on_time_delivery_rate"),
        percent(F.col("canceled_rows"), F.col("rows")).alias("cancellation_rate"),
        round_to(ratio(F.col("score_sum"), F.col("scored_rows")), 2).alias("avg_review_score"),
    )


def person_months(star: StarSchema) -> DataFrame:
    """month, customer_unique_id: completed orders with a payment, what was paid, payments with a value."""
    sums = ["orders", "paid", "valued_rows"]
    by_account = (
        completed(star.fact_orders)
        .select("order_id", "customer_id", F.trunc("order_purchase_timestamp", "month").alias("month"))
        .join(payment_totals(star), "order_id")
        .groupBy("month", "customer_id")
        .agg(
            F.count("*").alias("orders"),
            F.sum("paid").alias("paid"),
            F.sum("valued_rows").alias("valued_rows"),
        )
    )
    return (
        by_account.join(star.dim_customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("month", "customer_unique_id")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )


def revenue_monthly(star: StarSchema) -> DataFrame:
    """Orders, customers and revenue per month, with growth over the month before."""
    return revenue_monthly_of(person_months(star))


def revenue_monthly_of(months: DataFrame) -> DataFrame:
    """:func:`revenue_monthly` from sums per month and person."""
    by_month = months.groupBy("month").agg(
        F.count("customer_unique_id").alias("people"),
        *[F.sum(name).alias(name) for name in ("orders", "paid", "valued_rows")],
    )
    # From here on there is one row per month.
    before = F.lag("paid").over(Window.orderBy(F.asc_nulls_last("month")))
    return (
        by_month.withColumn("before", before)
        .select(
            "month",
            F.date_format("month", "yyyy-MM").alias("month_label"),
            F.col("orders").alias("total_orders"),
            F.col("people").alias("unique_customers"),
            _money(F.col("paid")).alias("revenue"),
            round_to(ratio(F.col("paid"), F.col("valued_rows")), 2).alias("avg_order_value"),
            _money(F.col("before")).alias("prev_month_revenue"),
            percent(F.col("paid") - F.col("before"), F.col("before")).alias("mom_growth_pct"),
        )
        .orderBy("month")
    )


CATEGORY_SUMS = ["revenue", "line_rows", "score_sum", "scored_rows"]


def product_sums(star: StarSchema) -> DataFrame:
    """Per product_id of completed orders: orders and the sums behind the category KPIs."""
    sums = [F.sum(name).alias(name) for name in CATEGORY_SUMS]
    return order_products(star).groupBy("product_id").agg(F.count("*").alias("orders"), *sums)


def _categories(star: StarSchema) -> DataFrame:
    return star.dim_products.filter(F.col("product_category_name").isNotNull()).select(
        "product_id", F.col("product_category_name").alias("category")
    )


def category_orders(star: StarSchema) -> DataFrame:
    """Per category how many completed orders hold one of its products."""
    # As in :func:`product_sums`, so that a report on both reads what was shuffled once.
    return (
        order_products(star)
        .select("order_id", "product_id")
        .join(_categories(star), "product_id")
        .select("category", "order_id")
        .distinct()
        .groupBy("category")
        .agg(F.count("*").alias("total_orders"))
    )


def top_categories(star: StarSchema) -> DataFrame:
    return top_categories_of(product_sums(star), category_orders(star), star)


def top_categories_of(products: DataFrame, orders: DataFrame, star: StarSchema) -> DataFrame:
    """:func:`top_categories` from sums per product and orders per category; ``star`` names the categories."""
    # A best-selling product meets its category as one row of sums.
    by_category = (
        products.join(_categories(star), "product_id")
        .groupBy("category")
        .agg(F.count("*").alias("unique_products"), *[F.sum(name).alias(name) for name in CATEGORY_SUMS])
        .join(orders, "category")
    )
    # From here on there is one row per category.
    return by_category.select(
        "category",
        "total_orders",
        "unique_products",
        _money(F.col("revenue")).alias("total_revenue"),
        round_to(ratio(F.col("revenue"), F.col("line_rows")), 2).alias("avg_price"),
        round_to(ratio(F.col("score_sum"), F.col("scored_rows")), 2).alias("avg_review_score"),
        share_of_all("revenue").alias("revenue_share_pct"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
    ).orderBy(F.desc("total_revenue"), "category")


def delivery_months(star: StarSchema) -> DataFrame:
    """Per purchase month the sums behind the delivery KPIs."""
    bought = F.col("order_purchase_timestamp")
    received = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    needed, estimated = F.datediff(received, bought), F.datediff(promised, bought)
    return (
        star.fact_orders.filter((F.col("order_status") == "delivered") & received.isNotNull())
        .groupBy(F.trunc(bought, "month").alias("month"))
        .agg(
            F.count("*").alias("delivered"),
            F.sum(needed).alias("needed_days"),
            F.count(needed).alias("needed_rows"),
            F.sum(estimated).alias("promised_days"),
            F.count(estimated).alias("promised_rows"),
            F.count_if(received <= promised).alias("on_time"),
            F.count_if(received > promised).alias("late"),
        )
    )


def delivery_performance(star: StarSchema) -> DataFrame:
    """Delivered orders per month: days needed, days promised, share on time."""
    return delivery_performance_of(delivery_months(star))


def delivery_performance_of(months: DataFrame) -> DataFrame:
    """:func:`delivery_performance` from sums per month."""
    return months.select(
        "month",
        F.date_format("month", "yyyy-MM").alias("month_label"),
        F.col("delivered").alias("total_delivered"),
        round_to(ratio(F.col("needed_days"), F.col("needed_rows")), 1).alias("avg_delivery_days"),
        round_to(ratio(F.col("promised_days"), F.col("promised_rows")), 1).alias("avg_estimated_days"),
        F.col("on_time").alias("on_time_count"),
        F.col("late").alias("late_count"),
        percent(F.col("on_time"), F.col("delivered")).alias("on_time_rate"),
    ).orderBy("month")


def rfm_segments_mart(
    star: StarSchema, ref_date: date | None = None, high_is_best: bool = False
) -> DataFrame:
    return segments_of(rfm_scored(star, ref_date, high_is_best))


def segments_of(scored: DataFrame) -> DataFrame:
    """:func:`rfm_segments_mart` from scored people."""

    def mean(name: str) -> Column:
        return round_to(ratio(F.sum(name), F.count(name)), 2)

    return (
        scored
        .withColumn("monetary", F.col("monetary").cast("decimal(38,2)"))
        .groupBy(segment("mart"))
        .agg(
            F.count("*").alias("total_customers"),
            mean("monetary").alias("avg_monetary"),
            mean("frequency_orders").alias("avg_frequency"),
            mean("recency_days").alias("avg_recency_days"),
        )
        .select(
            "segment",
            "total_customers",
            share_of_all("total_customers").alias("percentage"),
            "avg_monetary",
            "avg_frequency",
            "avg_recency_days",
        )
        .orderBy(F.desc("total_customers"), "segment")
    )
