"""Every operator as a query over the driver tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ordersight.operators import anomaly, cleaning, cohort, marts, quality, ranking, rfm
from ordersight.plans.first_row import keep_first
from ordersight.plans.shared_store import run_folder
from ordersight.sources import csv_files, published, star_tables
from ordersight.sources.driver_tables import (
    RAW_ORDER,
    raw_dataset,
    raw_from_driver_tables,
    seller_line_bounds,
    star_from_driver_tables,
)
from ordersight.sources.mart_states import MartStates
from ordersight.star import STAR_SCHEMAS, StarSchema

Query = Callable[[SparkSession, str], DataFrame]

RANGE = (date(1998, 1, 1), date(1998, 3, 31))
SINCE = date(1998, 1, 1)


def _on_star(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: operator(star_from_driver_tables(spark, folder), **options)


def _on_cleaned(operator: Callable[[StarSchema], DataFrame]) -> Query:
    """Over a star cleaned from the faulty raw datasets, where checks find something."""
    return lambda spark, folder: operator(
        star_tables.clean_star(raw_from_driver_tables(spark, folder), RAW_ORDER)
    )


def _on_sellers(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: operator(
        star_from_driver_tables(spark, folder),
        row_bounds=seller_line_bounds(spark, folder),
        **options,
    )


def _cleaned(dataset: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        raw = raw_dataset(spark, folder, dataset)
        cleaner = star_tables.CLEANERS[dataset]
        if dataset in cleaning.UNIQUE:
            return cleaner(raw, RAW_ORDER)
        return _doubles(cleaner(raw).drop(*RAW_ORDER))

    return query


def _doubles(df: DataFrame) -> DataFrame:
    """Amounts as doubles, which every engine hands out alike."""
    amounts = [field.name for field in df.schema if isinstance(field.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in amounts})


def _new_folder(spark: SparkSession) -> str:
    return f"{run_folder(spark)}/{uuid.uuid4().hex}"


def _read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and values per dataset after a trip through CSV files."""
    target = _new_folder(spark)
    for name, df in raw_from_driver_tables(spark, folder).items():
        columns = csv_files.RAW_COLUMNS[name]
        csv_files.write_clean(df.select(*columns), target, name)
    read = csv_files.read_raw(
        spark, target, {name: f"{name}_clean.csv" for name in csv_files.RAW_COLUMNS}
    )
    parts = []
    for name, df in read.items():
        values = [F.count(column) for column in csv_files.RAW_COLUMNS[name]]
        parts.append(
            df.agg(
                F.lit(name).alias("dataset"),
                F.count("*").alias("rows_read"),
                reduce(lambda a, b: a + b, values).alias("values_read"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _run_etl(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the star's tables after the same raw data was loaded twice."""
    target = _new_folder(spark)
    home = star_tables.StarHome(f"{target}/star")
    raw = raw_from_driver_tables(spark, folder)
    star_tables.run_etl(raw, home, f"{target}/processed", order=RAW_ORDER, null_keys="drop")
    return quality.row_counts(star_tables.run_etl(raw, home, order=RAW_ORDER, null_keys="drop"))


def _load_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The payments table after a batch was loaded twice onto stored payments."""
    home = star_tables.StarHome(f"{_new_folder(spark)}/star")
    star_tables.create_star(spark, home)
    star_tables.load_idempotent(star_from_driver_tables(spark, folder).fact_order_payments, home, "fact_order_payments")
    batch = cleaning.clean_order_payments(raw_dataset(spark, folder, "payments"))
    for _ in range(2):
        star_tables.load_idempotent(batch, home, "fact_order_payments", RAW_ORDER)
    return _doubles(star_tables.read_star(spark, home).fact_order_payments)


def _rfm_null_person(spark: SparkSession, folder: str) -> DataFrame:
    """Scores where some accounts name no person."""
    star = star_from_driver_tables(spark, folder)
    person = F.col("customer_unique_id")
    named = star.dim_customers.withColumn("customer_unique_id", F.when(person % 1000 != 40, person))
    return rfm.rfm_scored(star.replace(dim_customers=named))


def _pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return quality.pk_violations(star_from_driver_tables(spark, folder)).unionByName(
        quality.key_violations("raw_lineitem", lines, ["l_orderkey", "l_linenumber"])
    )


def _check_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The score check on reviews whose scores were not filtered yet."""
    raw = raw_dataset(spark, folder, "reviews")
    scored = raw.withColumn("review_score", F.col("review_score").try_cast("int"))
    star = star_from_driver_tables(spark, folder)
    return quality.check_violations(star.replace(fact_order_reviews=scored))


def _dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", *columns
    )
    return keep_first(lines, ["l_orderkey", "l_linenumber"], columns).drop("l_shipdate")


def _refresh_all(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every stored KPI table."""
    target = _new_folder(spark)
    published.refresh_all(star_from_driver_tables(spark, folder), target)
    return reduce(
        DataFrame.unionByName,
        [
            published.read_mart(spark, target, name).agg(
                F.lit(name).alias("mart"), F.count("*").alias("rows_stored")
            )
            for name in published.MARTS
        ],
    )


# Key column and values of each KPI table.
MART_VALUES = {
    "kpi_general": (None, ["total_orders", "unique_customers", "active_sellers", "products_sold", "total_revenue", "avg_order_value", "revenue_per_customer", "on_time_delivery_rate", "cancellation_rate", "avg_review_score"]),
    "revenue_monthly": ("month_label", ["total_orders", "unique_customers", "revenue", "avg_order_value", "prev_month_revenue", "mom_growth_pct"]),
    "top_categories": ("category", ["total_orders", "unique_products", "total_revenue", "avg_price", "avg_review_score", "revenue_share_pct", "revenue_rank"]),
    "delivery_performance": ("month_label", ["total_delivered", "avg_delivery_days", "avg_estimated_days", "on_time_count", "late_count", "on_time_rate"]),
    "rfm_segments": ("segment", ["total_customers", "percentage", "avg_monetary", "avg_frequency", "avg_recency_days"]),
}


def _refresh_changed(spark: SparkSession, folder: str) -> DataFrame:
    """All values of the KPI tables after a second load, refreshed from stored sums."""
    target = _new_folder(spark)
    home = star_tables.StarHome(f"{target}/star")
    star_tables.create_star(spark, home)
    star = star_from_driver_tables(spark, folder)
    # Ids are stored as text; of equal length they sort as the numbers do.
    person = F.lpad(F.col("customer_unique_id").cast("string"), 12, "0")
    star = star.replace(dim_customers=star.dim_customers.withColumn("customer_unique_id", person))
    loads = {
        "dim_customers": F.col("customer_id") % 3 != 0,
        "dim_products": F.col("product_id") % 10 != 0,
        "fact_orders": F.col("order_id") % 4 != 0,
        "fact_order_items": F.col("order_item_id") % 2 != 0,
        "fact_order_payments": F.col("payment_sequential") != 2,
        "fact_order_reviews": F.col("review_id") % 3 != 0,
    }
    for first in (True, False):
        for table, part in loads.items():
            rows = star.table(table)
            star_tables.load_idempotent(rows.where(part) if first else rows, home, table)
        if first:
            MartStates(spark, home, f"{target}/marts/_states").update()
    published.refresh_changed(spark, home, f"{target}/marts")
    parts = []
    for mart, (key, columns) in MART_VALUES.items():
        df = published.read_mart(spark, f"{target}/marts", mart)
        named = df.select(F.col(key).alias("name") if key else F.lit("all").alias("name"), *[F.col(c).cast("double").alias(c) for c in columns])
        parts.append(named.unpivot(["name"], columns, "measure", "value").withColumn("mart", F.lit(mart)))
    return reduce(DataFrame.unionByName, parts)


def _create_star(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of the created tables as their files hold them, with the values loaded into each."""
    home = star_tables.StarHome(f"{_new_folder(spark)}/star")
    star_tables.store_star(star_from_driver_tables(spark, folder), home)
    parts = []
    for name in STAR_SCHEMAS:
        # No schema is given: names, order and types come from the files.
        stored = spark.read.parquet(home.path(name))
        fields = [
            F.struct(F.lit(place).alias("place"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("kind"), F.count(f.name).alias("n_values"))
            for place, f in enumerate(stored.schema, 1)
        ]
        parts.append(stored.agg(F.array(*fields).alias("fields")).select(F.lit(name).alias("table_name"), F.inline("fields")))
    return reduce(DataFrame.unionByName, parts)


def _write_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned reviews after a trip through a snapshot file."""
    cleaned = cleaning.clean_reviews(raw_dataset(spark, folder, "reviews"), RAW_ORDER)
    path = csv_files.write_clean(cleaned, _new_folder(spark), "order_reviews")
    return spark.read.schema(cleaned.schema).options(header=True, multiLine=True, escape='"').csv(path)


QUERIES: dict[str, Query] = {
    "row_counts": _on_star(quality.row_counts),
    "orphan_items": _on_cleaned(quality.orphan_items),
    "orphan_payments": _on_cleaned(quality.orphan_payments),
    "orphan_reviews": _on_cleaned(quality.orphan_reviews),
    "critical_nulls": _on_cleaned(quality.critical_nulls),
    "date_coverage": _on_star(quality.date_coverage),
    "status_distribution": _on_star(quality.status_distribution),
    "fk_violations": _on_cleaned(quality.fk_violations),
    "pk_violations": _pk_violations,
    "check_violations": _check_violations,
    "length_violations": _on_star(quality.length_violations),
    "null_profile": lambda spark, folder: cleaning.null_profile(
        raw_dataset(spark, folder, "orders").drop(*RAW_ORDER)
    ),
    "clean_customers": _cleaned("customers"),
    "clean_products": _cleaned("products"),
    "clean_sellers": _cleaned("sellers"),
    "clean_orders": _cleaned("orders"),
    "clean_order_items": _cleaned("order_items"),
    "clean_order_payments": _cleaned("payments"),
    "clean_reviews": _cleaned("reviews"),
    "clean_metrics": lambda spark, folder: cleaning.clean_metrics(
        raw_from_driver_tables(spark, folder), RAW_ORDER
    ),
    "dim_date": lambda spark, folder: cleaning.build_dim_date(
        raw_dataset(spark, folder, "orders")
    ),
    "dedup_keep_first": _dedup_keep_first,
    "load_idempotent": _load_idempotent,
    "read_raw": _read_raw,
    "run_etl": _run_etl,
    "refresh_all": _refresh_all,
    "refresh_changed": _refresh_changed,
    "write_clean": _write_clean,
    "create_star": _create_star,
    "rfm_reference_date": _on_star(rfm.rfm_reference_date),
    "orders_with_payment": lambda spark, folder: rfm.orders_with_payment(
        star_from_driver_tables(spark, folder)
    ).withColumn("order_value", F.col("order_value").cast("double")),
    "rfm_raw": lambda spark, folder: rfm.rfm_raw(star_from_driver_tables(spark, folder)).withColumn(
        "monetary", F.col("monetary").cast("double")
    ),
    "rfm_scored": _on_star(rfm.rfm_scored),
    "rfm_scored_high_is_best": _on_star(rfm.rfm_scored, high_is_best=True),
    "rfm_scored_null_person": _rfm_null_person,
    "rfm_simple": _on_star(rfm.rfm_simple),
    "rfm_segments_detail": _on_star(rfm.rfm_segments_detail),
    "rfm_segment_summary": _on_star(rfm.rfm_segment_summary),
    "first_purchase": _on_star(cohort.first_purchase),
    "all_purchases": _on_star(cohort.all_purchases),
    "cohort_sizes": _on_star(cohort.cohort_sizes),
    "cohort_activity": _on_star(cohort.cohort_activity),
    "cohort_retention": _on_star(cohort.cohort_retention),
    "cohort_pivot": _on_star(cohort.cohort_pivot),
    "repurchase_interval": _on_star(cohort.repurchase_interval),
    "payment_outliers": _on_star(anomaly.payment_outliers),
    "weekly_sales": _on_star(anomaly.weekly_sales),
    "weekly_sales_drop": _on_star(anomaly.weekly_sales_drop, min_prev=2),
    "daily_volume_outliers": _on_star(anomaly.daily_volume_outliers),
    "late_deliveries": _on_star(anomaly.late_deliveries),
    "product_week_zscore": _on_star(anomaly.product_week_zscore),
    "product_metrics": _on_star(ranking.product_metrics),
    "product_ranking": _on_star(ranking.product_ranking),
    "product_ranking_spread": _on_star(ranking.product_ranking, max_group_rows=0),
    "top_products": _on_star(ranking.top_products),
    "seller_deliveries": _on_sellers(ranking.seller_deliveries),
    "seller_deliveries_spread": _on_sellers(ranking.seller_deliveries, max_group_rows=590),
    "seller_delivery_trend": _on_sellers(ranking.seller_delivery_trend),
    "seller_trend_summary": _on_sellers(ranking.seller_trend_summary),
    "orders_in_range": _on_star(ranking.orders_in_range, first=RANGE[0], last=RANGE[1]),
    "product_revenue_since": _on_star(ranking.product_revenue_since, since=SINCE),
    "kpi_general": _on_star(marts.kpi_general),
    "revenue_monthly": _on_star(marts.revenue_monthly),
    "top_categories": _on_star(marts.top_categories),
    "delivery_performance": _on_star(marts.delivery_performance),
    "rfm_segments_mart": _on_star(marts.rfm_segments_mart),
}
