"""The star schema: table types, keys, and the object that carries the tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

TEXT = StringType()
INT = IntegerType()
DAY = DateType()
MONEY = DecimalType(10, 2)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Column names, order and types of the eight tables.
STAR_SCHEMAS: dict[str, StructType] = {
    "dim_customers": _table(
        customer_id=TEXT,
        customer_unique_id=TEXT,
        customer_zip_code_prefix=TEXT,
        customer_city=TEXT,
        customer_state=TEXT,
    ),
    "dim_products": _table(
        product_id=TEXT,
        product_category_name=TEXT,
        product_name_length=INT,
        product_description_length=INT,
        product_photos_qty=INT,
        product_weight_g=INT,
        product_length_cm=INT,
        product_height_cm=INT,
        product_width_cm=INT,
    ),
    "dim_sellers": _table(
        seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT
    ),
    "dim_date": _table(
        date_id=DAY, year=INT, quarter=INT, month=INT, week=INT, day=INT, is_weekend=BooleanType()
    ),
    "fact_orders": _table(
        order_id=TEXT,
        customer_id=TEXT,
        order_status=TEXT,
        order_purchase_timestamp=DAY,
        order_approved_at=DAY,
        order_delivered_carrier_date=DAY,
        order_delivered_customer_date=DAY,
        order_estimated_delivery_date=DAY,
    ),
    "fact_order_items": _table(
        order_id=TEXT,
        order_item_id=INT,
        product_id=TEXT,
        seller_id=TEXT,
        price=MONEY,
        freight_value=MONEY,
    ),
    "fact_order_payments": _table(
        order_id=TEXT,
        payment_sequential=INT,
        payment_type=TEXT,
        payment_installments=INT,
        payment_value=MONEY,
    ),
    "fact_order_reviews": _table(
        review_id=TEXT,
        order_id=TEXT,
        review_score=INT,
        review_creation_date=DAY,
        review_answer_timestamp=DAY,
    ),
}

# Primary keys.
PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_date": ["date_id"],
    "fact_orders": ["order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_order_payments": ["order_id", "payment_sequential"],
    "fact_order_reviews": ["review_id"],
}

# Fixed values: (constraint, child table, child column, parent table, parent column).
FOREIGN_KEYS: list[tuple[str, str, str, str, str]] = [
    ("fk_orders_customer", "fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fk_orders_date", "fact_orders", "order_purchase_timestamp", "dim_date", "date_id"),
    ("fk_items_orders", "fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fk_items_products", "fact_order_items", "product_id", "dim_products", "product_id"),
    ("fk_items_sellers", "fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fk_payments_orders", "fact_order_payments", "order_id", "fact_orders", "order_id"),
    ("fk_reviews_orders", "fact_order_reviews", "order_id", "fact_orders", "order_id"),
]

# Longest text each column may hold.
TEXT_LENGTHS: dict[str, dict[str, int]] = {
    "dim_customers": {
        "customer_id": 50,
        "customer_unique_id": 50,
        "customer_zip_code_prefix": 10,
        "customer_city": 100,
        "customer_state": 2,
    },
    "dim_products": {"product_id": 50, "product_category_name": 100},
    "dim_sellers": {
        "seller_id": 50,
        "seller_zip_code_prefix": 10,
        "seller_city": 50,
        "seller_state": 2,
    },
    "fact_orders": {"order_id": 50, "customer_id": 50, "order_status": 20},
    "fact_order_items": {"order_id": 50, "product_id": 50, "seller_id": 50},
    "fact_order_payments": {"order_id": 50, "payment_type": 30},
    "fact_order_reviews": {"review_id": 50, "order_id": 50},
}


class StarSchema:
    """The eight tables, as attributes under their names.

    Each is given as a DataFrame or as a function that makes one, which is
    called when the table is first used. ``payment_totals`` may hold a stored
    result of :func:`ordersight.plans.per_order.payment_totals`, so that several
    reports over one load share it. ``line_bound`` counts the order lines, or gives
    an upper bound, where that is cheap; see :func:`ordersight.plans.per_order.by_order`.
    """

    dim_customers: DataFrame
    dim_products: DataFrame
    dim_sellers: DataFrame
    dim_date: DataFrame
    fact_orders: DataFrame
    fact_order_items: DataFrame
    fact_order_payments: DataFrame
    fact_order_reviews: DataFrame

    def __init__(
        self,
        payment_totals: DataFrame | None = None,
        line_bound: Callable[[], int] | None = None,
        **tables: DataFrame | Callable[[], DataFrame],
    ) -> None:
        if set(tables) != set(STAR_SCHEMAS):
            raise ValueError(f"expected the tables {sorted(STAR_SCHEMAS)}, got {sorted(tables)}")
        self._tables = tables
        self.payment_totals = payment_totals
        self.line_bound = cache(line_bound) if line_bound else None

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR_SCHEMAS:
            raise AttributeError(name)
        table = self._tables[name]
        if callable(table):
            table = self._tables[name] = table()
        return table

    def replace(self, payment_totals: DataFrame | None = None, **tables: DataFrame) -> StarSchema:
        if payment_totals is None:
            payment_totals = self.payment_totals
        line_bound = None if "fact_order_items" in tables else self.line_bound
        return StarSchema(payment_totals, line_bound, **{**self._tables, **tables})

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STAR_SCHEMAS}

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
