"""Customers grouped by the month of their first purchase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions import percent, whole_percent
from ordersight.plans.per_order import completed
from ordersight.star import StarSchema

LAST_MONTH = 6

# Fixed values. The capital letter is as defined for this report: where statuses
# are lower case, canceled orders stay in.
NOT_REPURCHASES = ("Canceled", "unavailable")


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def _months_between(first: Column, later: Column) -> Column:
    return (F.year(later) - F.year(first)) * 12 + (F.month(later) - F.month(first))


def first_purchase(star: StarSchema) -> DataFrame:
    """Per person: first_purchase_date and cohort_month."""
    by_account = (
        completed(star.fact_orders)
        .groupBy("customer_id")
        .agg(F.min("order_purchase_timestamp").alias("first_day"))
    )
    return (
        by_account.join(star.dim_customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.min("first_day").alias("first_purchase_date"))
        .withColumn("cohort_month", _month(F.col("first_purchase_date")))
    )


def _account_cohorts(star: StarSchema) -> DataFrame:
    """customer_id, customer_unique_id, cohort_month: one row per account."""
    return star.dim_customers.select("customer_id", "customer_unique_id").join(
        first_purchase(star).select("customer_unique_id", "cohort_month"), "customer_unique_id"
    )


def all_purchases(star: StarSchema) -> DataFrame:
    """Each completed order with its buyer's cohort and the months since."""
    day = F.col("order_purchase_timestamp")
    return (
        completed(star.fact_orders)
        .select("customer_id", "order_purchase_timestamp")
        .join(_account_cohorts(star), "customer_id")
        .select(
            "customer_unique_id",
            "cohort_month",
            _month(day).alias("purchase_month"),
            _months_between(F.col("cohort_month"), day).alias("month_number"),
        )
    )


def cohort_activity(star: StarSchema) -> DataFrame:
    """cohort_month, month_number, active_customers."""
    month = F.col("purchase_month")
    # Months before joins: a busy account brings at most one row per month.
    account_months = (
        completed(star.fact_orders)
        .select("customer_id", _month(F.col("order_purchase_timestamp")).alias("purchase_month"))
        .distinct()
    )
    people_months = (
        account_months.join(star.dim_customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .select("customer_unique_id", "purchase_month")
        .distinct()
    )
    # A person has at most one row per month now, so the window is short; the
    # month of the first purchase is the first of the person's months.
    first_month = F.min(month).over(Window.partitionBy("customer_unique_id"))
    return (
        people_months.select(first_month.alias("cohort_month"), "purchase_month")
        .groupBy("cohort_month", _months_between(F.col("cohort_month"), month).alias("month_number"))
        .agg(F.count("*").alias("active_customers"))
    )


def cohort_sizes(star: StarSchema) -> DataFrame:
    """cohort_month, cohort_size: the customers active in month 0."""
    return (
        cohort_activity(star)
        .filter(F.col("month_number") == 0)
        .select("cohort_month", F.col("active_customers").alias("cohort_size"))
    )


def cohort_retention(star: StarSchema, last_month: int = LAST_MONTH) -> DataFrame:
    """Share of each cohort that bought again in months 0 to ``last_month``."""
    at_start = F.when(F.col("month_number") == 0, F.col("active_customers"))
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return (
        cohort_activity(star)
        .filter(F.col("month_number").between(0, last_month))
        .withColumn("initial_customers", size)
        .select(
            F.date_format("cohort_month", "yyyy-MM").alias("cohort"),
            "month_number",
            "initial_customers",
            "active_customers",
            percent(F.col("active_customers"), F.col("initial_customers")).alias("retention_rate"),
        )
        .orderBy("cohort", "month_number")
    )


def cohort_pivot(star: StarSchema, last_month: int = LAST_MONTH) -> DataFrame:
    """One row per cohort; Mes_n is the whole percentage active in month n."""
    months = range(last_month + 1)
    active = {m: F.max(F.when(F.col("month_number") == m, F.col("active_customers"))) for m in months}
    return (
        cohort_activity(star)
        .filter(F.col("month_number").between(0, last_month))
        .groupBy("cohort_month")
        .agg(*[active[m].alias(f"active_{m}") for m in months])
        .select(
            F.date_format("cohort_month", "yyyy-MM").alias("cohort"),
            F.col("active_0").alias("cohort_size"),
            *[whole_percent(F.col(f"active_{m}"), F.col("active_0")).alias(f"Mes_{m}") for m in months],
        )
        .orderBy("cohort")
    )


def repurchase_interval(
    star: StarSchema, excluded: tuple[str, ...] = NOT_REPURCHASES
) -> DataFrame:
    """One row: days between the first and second order of a customer."""

    def first_two(df: DataFrame, key: str) -> DataFrame:
        # Spark keeps two rows per key in each map task before it shuffles.
        by_day = Window.partitionBy(key).orderBy(
            F.asc_nulls_last("order_purchase_timestamp"), "order_id"
        )
        return df.withColumn("place", F.row_number().over(by_day)).filter(F.col("place") <= 2)

    orders = completed(star.fact_orders, excluded).select(
        "customer_id", "order_id", "order_purchase_timestamp"
    )
    accounts = star.dim_customers.select("customer_id", "customer_unique_id")
    by_account = first_two(orders, "customer_id").drop("place").join(accounts, "customer_id")
    day = F.col("order_purchase_timestamp")
    days = (
        first_two(by_account, "customer_unique_id")
        .groupBy("customer_unique_id")
        .agg(F.count(day).alias("orders"), F.datediff(F.max(day), F.min(day)).alias("days"))
        .filter(F.col("orders") == 2)
    )
    return days.agg(
        F.avg("days").alias("avg_days_between_purchases"),
        F.min("days").alias("min_days_between_purchases"),
        F.max("days").alias("max_days_between_purchases"),
        # Exact; it keeps one counter per distinct number of days.
        F.percentile("days", 0.5).alias("median_days_between_purchases"),
    )
