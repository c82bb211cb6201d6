"""Recency, frequency and monetary value of customers."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions import percent
from ordersight.plans.per_order import completed, payment_totals
from ordersight.plans.tiles import add_ntiles
from ordersight.star import StarSchema

SCORES = ["recency_score", "frequency_score", "monetary_score"]
MISSING = Decimal(10**30)  # sorts after every real day count or amount

# Fixed values: (least recency, frequency and monetary score, segment), first match wins.
DETAIL_RULES = [
    (4, 4, 4, "Champions"),
    (3, 3, 1, "Loyal customers"),
    (4, 2, 1, "New customers"),
    (2, 3, 1, "At risk"),
    (1, 1, 1, "Lost"),
    (1, 2, 4, "Big Spenders"),
]
DETAIL_OTHER = "Potential Loyalist"

# Fixed values: (recency, frequency and monetary score range, segment), first match wins.
MART_RULES = [
    ((4, 5), (4, 5), (4, 5), "Champions"),
    ((3, 5), (3, 5), (1, 5), "Loyal Customers"),
    ((4, 5), (1, 2), (1, 5), "New customers"),
    ((1, 2), (3, 5), (1, 5), "At Risk"),
    ((1, 1), (1, 1), (1, 5), "Lost"),
    ((1, 5), (1, 2), (4, 5), "Big Spenders"),
]
MART_OTHER = "Potential Loyalists"


def rfm_reference_date(star: StarSchema) -> DataFrame:
    """One row, ref_date: the day after the last order."""
    last = F.max("order_purchase_timestamp")
    return star.fact_orders.agg(F.date_add(last, 1).alias("ref_date"))


def _ref_day(star: StarSchema, ref_date: date | None) -> Column:
    return F.lit(ref_date) if ref_date is not None else rfm_reference_date(star).scalar()


def orders_with_payment(star: StarSchema) -> DataFrame:
    """Completed orders that have a payment, with their total."""
    return (
        completed(star.fact_orders)
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(payment_totals(star).select("order_id", F.col("paid").alias("order_value")), "order_id")
    )


def buyers(star: StarSchema) -> DataFrame:
    """Per customer_unique_id: last_purchase_date, frequency_orders, monetary."""
    # Orders are summed by account before they meet the customer table, so an
    # account with very many orders joins as one row.
    by_account = (
        orders_with_payment(star)
        .groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_day"),
            F.count("*").alias("orders"),
            F.sum("order_value").alias("spent"),
        )
    )
    accounts = star.dim_customers.select("customer_id", "customer_unique_id")
    return (
        by_account.join(accounts, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max("last_day").alias("last_purchase_date"),
            F.sum("orders").alias("frequency_orders"),
            F.sum("spent").cast("decimal(38,2)").alias("monetary"),
        )
    )


def rfm_raw(star: StarSchema, ref_date: date | None = None) -> DataFrame:
    """Per person: last_purchase_date, recency_days, frequency_orders, monetary."""
    return recency_of(buyers(star), _ref_day(star, ref_date))


def recency_of(people: DataFrame, ref_day: Column) -> DataFrame:
    """:func:`rfm_raw` from the sums per person and the day recency is counted to."""
    return people.select(
        "customer_unique_id",
        "last_purchase_date",
        F.datediff(ref_day, "last_purchase_date").alias("recency_days"),
        "frequency_orders",
        "monetary",
    )


def rfm_scored(
    star: StarSchema,
    ref_date: date | None = None,
    high_is_best: bool = False,
) -> DataFrame:
    """:func:`rfm_raw` with three scores from 1 to 5.

    By default the most recent, most frequent and highest spending fifth gets
    1; ``high_is_best`` turns the scale round. Equal values are split by
    customer_unique_id.
    """
    return scores_of(rfm_raw(star, ref_date), high_is_best)


def scores_of(raw: DataFrame, high_is_best: bool = False) -> DataFrame:
    """:func:`rfm_scored` from the result of :func:`rfm_raw`."""
    sign = -1 if high_is_best else 1
    recency, frequency, monetary = F.col("recency_days"), F.col("frequency_orders"), F.col("monetary")
    scored = add_ntiles(
        raw,
        {
            "recency_score": F.coalesce(recency * sign, F.lit(sign * MISSING).cast("decimal(38,2)")),
            "frequency_score": -sign * frequency,
            "monetary_score": F.coalesce(
                monetary * F.lit(-sign), F.lit(-sign * MISSING).cast("decimal(38,2)")
            ),
        },
        tiebreak="customer_unique_id",
    )
    return scored.withColumn("monetary", monetary.cast("double"))


def _total_score() -> Column:
    return (F.col(SCORES[0]) + F.col(SCORES[1]) + F.col(SCORES[2])).alias("rfm_total")


def rfm_simple(star: StarSchema, ref_date: date | None = None) -> DataFrame:
    """Scores under short names and their sum, without segments."""
    return rfm_scored(star, ref_date).select(
        "customer_unique_id",
        "recency_days",
        F.col("frequency_orders").alias("frequency"),
        "monetary",
        F.col("recency_score").alias("r_score"),
        F.col("frequency_score").alias("f_score"),
        F.col("monetary_score").alias("m_score"),
        _total_score(),
    )


def segment(rules: str = "detail") -> Column:
    """The segment of a scored row under the ``detail`` or ``mart`` rules."""
    scores = [F.col(name) for name in SCORES]
    if rules == "detail":
        table = [((r, 5), (f, 5), (m, 5), label) for r, f, m, label in DETAIL_RULES]
        other = DETAIL_OTHER
    elif rules == "mart":
        table, other = MART_RULES, MART_OTHER
    else:
        raise ValueError(f"unknown rules {rules!r}")
    label = F.lit(other)
    for *ranges, name in reversed(table):
        matches = F.lit(True)
        for score, (low, high) in zip(scores, ranges):
            matches = matches & score.between(low, high)
        label = F.when(matches, name).otherwise(label)
    return label.alias("segment")


def rfm_segments_detail(
    star: StarSchema, ref_date: date | None = None, high_is_best: bool = False
) -> DataFrame:
    return (
        rfm_scored(star, ref_date, high_is_best)
        .select(
            "customer_unique_id",
            "last_purchase_date",
            "recency_days",
            "frequency_orders",
            "monetary",
            *SCORES,
            _total_score(),
            segment("detail"),
        )
        .orderBy(F.desc("rfm_total"), "customer_unique_id")
    )


def share_of_all(total: str) -> Column:
    """Percentage of ``total`` in its sum over a result of few rows."""
    return percent(F.col(total), F.sum(total).over(Window.partitionBy()))


def rfm_segment_summary(
    star: StarSchema, ref_date: date | None = None, high_is_best: bool = False
) -> DataFrame:
    return (
        rfm_scored(star, ref_date, high_is_best)
        .groupBy(segment("detail"))
        .agg(F.count("*").alias("total_customers"))
        .withColumn("percentage", share_of_all("total_customers"))
        .orderBy(F.desc("total_customers"), "segment")
    )
