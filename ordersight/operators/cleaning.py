"""Cleaning of the seven raw datasets and the date dimension.

Each ``clean_*`` takes a raw frame of strings. Where duplicates are dropped the
first row in ``order`` stays; :func:`ordersight.sources.csv_files.read_raw`
supplies :data:`FILE_ORDER`, the place of a row in its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordersight.functions import strip_lower, to_day, to_money, to_number, to_whole
from ordersight.plans.first_row import keep_first

FILE_ORDER = ["_file", "_block", "_row"]

# Whole-number columns of the product table.
PRODUCT_NUMBERS = [
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]

# Date columns of the order table.
ORDER_DAYS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

# Columns without which a row is dropped, and the columns whose
# repeats are dropped, by dataset.
REQUIRED = {
    "customers": ["customer_id", "customer_unique_id"],
    "products": [],
    "sellers": [],
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id", "product_id", "seller_id"],
    "payments": ["order_id"],
    "reviews": ["review_id", "order_id"],
}
UNIQUE = {
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
    "orders": "order_id",
    "reviews": "review_id",
}


def _drop_repeats(df: DataFrame, dataset: str, order: list[str]) -> DataFrame:
    if dataset not in UNIQUE:
        return df
    return keep_first(df, [UNIQUE[dataset]], list(order))


def _finish(df: DataFrame, order: list[str]) -> DataFrame:
    return df.drop(*order)


def clean_customers(df: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    kept = _drop_repeats(df, "customers", order)
    return _finish(
        kept.dropna(subset=REQUIRED["customers"]).withColumns(
            {
                "customer_city": strip_lower(F.col("customer_city")),
                "customer_state": strip_lower(F.col("customer_state")),
                "customer_zip_code_prefix": F.coalesce("customer_zip_code_prefix", F.lit("00000")),
            }
        ),
        order,
    )


def clean_products(df: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    kept = _drop_repeats(df, "products", order)
    columns: dict[str, Column] = {
        "product_category_name": F.coalesce("product_category_name", F.lit("unknown"))
    }
    for name in PRODUCT_NUMBERS:
        columns[name] = F.coalesce(to_number(F.col(name)), F.lit(0.0)).cast("int")
    return _finish(kept.withColumns(columns), order)


def clean_sellers(df: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    kept = _drop_repeats(df, "sellers", order)
    return _finish(
        kept.withColumns(
            {
                "seller_city": strip_lower(F.col("seller_city")),
                "seller_state": strip_lower(F.col("seller_state")),
                "seller_zip_code_prefix": F.coalesce("seller_zip_code_prefix", F.lit("0")),
            }
        ),
        order,
    )


def clean_orders(df: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    kept = _drop_repeats(df, "orders", order).dropna(subset=REQUIRED["orders"])
    return _finish(kept.withColumns({name: to_day(F.col(name)) for name in ORDER_DAYS}), order)


def clean_order_items(df: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(10,2)")
    return df.dropna(subset=REQUIRED["order_items"]).withColumns(
        {
            "order_item_id": to_whole(F.col("order_item_id")),
            "price": F.coalesce(to_money(F.col("price")), zero),
            "freight_value": F.coalesce(to_money(F.col("freight_value")), zero),
        }
    )


def clean_order_payments(df: DataFrame) -> DataFrame:
    return df.dropna(subset=REQUIRED["payments"]).withColumns(
        {
            "payment_sequential": to_whole(F.col("payment_sequential")),
            "payment_installments": F.coalesce(
                to_number(F.col("payment_installments")), F.lit(1.0)
            ).cast("int"),
            "payment_value": F.coalesce(
                to_money(F.col("payment_value")), F.lit(0).cast("decimal(10,2)")
            ),
        }
    )


def clean_reviews(df: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    kept = _drop_repeats(df, "reviews", order).dropna(subset=REQUIRED["reviews"])
    score = to_number(F.col("review_score"))
    return _finish(
        kept.filter(score.between(1, 5)).withColumns(
            {
                "review_score": F.bround(score).cast("int"),
                "review_comment_title": F.coalesce("review_comment_title", F.lit("NA")),
                "review_comment_message": F.coalesce("review_comment_message", F.lit("NA")),
                "review_creation_date": to_day(F.col("review_creation_date")),
                "review_answer_timestamp": to_day(F.col("review_answer_timestamp")),
            }
        ),
        order,
    )


def build_dim_date(raw_orders: DataFrame) -> DataFrame:
    """One row per purchase day found in the raw orders."""
    day = F.col("date_id")
    return (
        raw_orders.select(to_day(F.col("order_purchase_timestamp")).alias("date_id"))
        .dropna()
        .distinct()
        .select("date_id", *calendar_parts(day))
    )


def calendar_parts(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def null_profile(df: DataFrame) -> DataFrame:
    """column_name, null_count for every column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def _lacks_required(dataset: str) -> Column:
    missing = F.lit(False)
    for name in REQUIRED[dataset]:
        missing = missing | F.col(name).isNull()
    return missing


def clean_metrics(raw: dict[str, DataFrame], order: list[str] = FILE_ORDER) -> DataFrame:
    """dataset, initial_rows, dropped_rows (no required key, after repeats are gone), each file read once."""
    result = None
    for dataset, df in raw.items():
        # Per row that stays after repeats are gone: rows before, and whether it will be dropped.
        lacks = _lacks_required(dataset).cast("int")
        if dataset in UNIQUE and REQUIRED[dataset]:
            rows = df.groupBy(UNIQUE[dataset]).agg(F.count("*").alias("rows"), F.min_by(lacks, F.struct(*order)).alias("lacks"))
        else:
            rows = df.select(F.lit(1).alias("rows"), lacks.alias("lacks"))
        counted = rows.agg(
            F.lit(dataset).alias("dataset"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("initial_rows"),
            F.coalesce(F.sum("lacks"), F.lit(0)).cast("bigint").alias("dropped_rows"),
        )
        result = counted if result is None else result.unionAll(counted)
    return result


class WatchedRows:
    """The counts of :func:`clean_metrics`, taken while a load cleans a dataset.

    Clean ``rows`` instead of the raw frame: repeats are gone from them already.
    """

    def __init__(self, raw: DataFrame, dataset: str, order: list[str] = FILE_ORDER):
        self._raw, self._kept = Observation(f"{dataset}_raw"), Observation(f"{dataset}_kept")
        watched = raw.observe(self._raw, F.count(F.lit(1)).alias("rows"))
        kept = _drop_repeats(watched, dataset, order)
        self.rows = kept.observe(self._kept, F.count_if(_lacks_required(dataset)).alias("dropped"))

    def counts(self) -> tuple[int, int]:
        """(initial_rows, dropped_rows); waits for the action that reads the rows."""
        return self._raw.get["rows"], self._kept.get["dropped"]
