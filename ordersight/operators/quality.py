"""Checks on a loaded star schema; none of them changes data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.star import FOREIGN_KEYS, PRIMARY_KEYS, TEXT_LENGTHS, StarSchema


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def row_counts(star: StarSchema) -> DataFrame:
    return _stack(
        [
            df.agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"))
            for name, df in star.tables().items()
        ]
    )


def _orphans(
    child: DataFrame, column: str, parent: DataFrame, key: str, null_is_orphan: bool
) -> DataFrame:
    """One row ``orphans``: child rows whose key has no parent.

    Child rows are counted by key first, so a key with very many rows meets the
    parent as a single row.
    """
    by_key = child.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("_rows"))
    if not null_is_orphan:
        by_key = by_key.filter(F.col("_key").isNotNull())
    parents = parent.select(F.col(key).alias("_key"))
    return by_key.join(parents, "_key", "left_anti").agg(_total("_rows").alias("orphans"))


def _without_order(star: StarSchema, table: str, label: str) -> DataFrame:
    # As NOT EXISTS does, a NULL order_id counts as missing.
    found = _orphans(star.table(table), "order_id", star.fact_orders, "order_id", True)
    return found.withColumnRenamed("orphans", label)


def orphan_items(star: StarSchema) -> DataFrame:
    return _without_order(star, "fact_order_items", "items_sin_orden")


def orphan_payments(star: StarSchema) -> DataFrame:
    return _without_order(star, "fact_order_payments", "pagos_sin_orden")


def orphan_reviews(star: StarSchema) -> DataFrame:
    return _without_order(star, "fact_order_reviews", "reviews_sin_orden")


def critical_nulls(star: StarSchema) -> DataFrame:
    return star.fact_orders.agg(
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_id"),
        F.count_if(F.col("order_status").isNull()).alias("null_status"),
        F.count_if(F.col("order_purchase_timestamp").isNull()).alias("null_purchase_date"),
    )


def date_coverage(star: StarSchema) -> DataFrame:
    day = F.col("order_purchase_timestamp")
    # Days first, so that distinct days are counted on as many rows as there are days.
    return (
        star.fact_orders.groupBy(day)
        .agg(F.count("*").alias("_rows"))
        .agg(
            F.min(day).alias("primera_order"),
            F.max(day).alias("ultima_order"),
            F.count(day).alias("dias_distintos"),
        )
    )


def status_distribution(star: StarSchema) -> DataFrame:
    return (
        star.fact_orders.groupBy("order_status")
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), F.asc_nulls_last("order_status"))
    )


def fk_violations(star: StarSchema) -> DataFrame:
    """constraint_name, violations; a NULL foreign key is allowed."""
    return _stack(
        [
            _orphans(star.table(child), column, star.table(parent), key, False).select(
                F.lit(name).alias("constraint_name"), F.col("orphans").alias("violations")
            )
            for name, child, column, parent, key in FOREIGN_KEYS
        ]
    )


def key_violations(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """table_name, duplicate_keys (keys seen more than once), null_key_rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    by_key = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return by_key.agg(
        F.lit(name).alias("table_name"),
        F.count_if(~any_null & (F.col("_rows") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("_rows"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
    )


def pk_violations(star: StarSchema) -> DataFrame:
    return _stack([key_violations(name, star.table(name), keys) for name, keys in PRIMARY_KEYS.items()])


def check_violations(star: StarSchema) -> DataFrame:
    """constraint_name, violations: review scores outside 1 to 5."""
    return star.fact_order_reviews.agg(
        F.lit("chk_review_score").alias("constraint_name"),
        F.count_if(~F.col("review_score").between(1, 5)).alias("violations"),
    )


def length_violations(star: StarSchema) -> DataFrame:
    """table_name, column_name, max_length, too_long; columns a table lacks are skipped."""
    parts = []
    for table, limits in TEXT_LENGTHS.items():
        df = star.table(table)
        known = {name: limit for name, limit in limits.items() if name in df.columns}
        counts = df.agg(
            *[
                F.count_if(F.length(F.col(name).cast("string")) > limit).alias(name)
                for name, limit in known.items()
            ]
        )
        limit_of = F.create_map(*[F.lit(part) for item in known.items() for part in item])
        parts.append(
            counts.unpivot([], list(known), "column_name", "too_long").select(
                F.lit(table).alias("table_name"),
                "column_name",
                limit_of[F.col("column_name")].alias("max_length"),
                "too_long",
            )
        )
    return _stack(parts)
