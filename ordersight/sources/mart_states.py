"""Sums behind the KPI tables, kept with a star and brought up to date by what was loaded.

Every KPI table follows from sums per key (a person, a month and person, a product, ...). Tables
only grow, so a load changes the sums of the orders it touches and of no others: those with a new
row in any fact, those of a new customer, and those with a line of a new product. For them the
difference between the sums over all rows and over those known before is found in one pass
(:mod:`ordersight.operators.mart_changes`) and appended to the stored sums. A large load touches
most orders, and finding them costs more than it saves: then all rows take part. Reading adds up the
appended parts; the first part holds everything, and many parts are put together into one.

A version lists the data files it covers and its parts, and counts once it is complete, so an
update that breaks off changes nothing. No load may run during an update.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType

from ordersight.operators import marts, rfm
from ordersight.operators.mart_changes import KNOWN, state_changes
from ordersight.plans.shared_store import store
from ordersight.sources.key_index import file_name
from ordersight.sources.star_tables import StarHome, files_of_keys, read_files, read_star, table_files
from ordersight.star import STAR_SCHEMAS, StarSchema

FACTS = ["fact_orders", "fact_order_items", "fact_order_payments", "fact_order_reviews"]
#: Appended parts that are put together into one.
MOST_PARTS = 16
#: Where one of so many rows of the facts is new, an update takes all rows and does not look for the touched orders.
MANY_NEW = 4


@dataclass(frozen=True)
class State:
    """Sums per key: which column tells that a key still has rows, which are maxima."""

    keys: tuple[str, ...]
    rows: str
    maxima: tuple[str, ...] = ()


STATES = {
    "person_kpis": State(("customer_unique_id",), "orders"),
    "seller_products": State(("seller_id", "product_id"), "lines"),
    "person_months": State(("month", "customer_unique_id"), "orders"),
    "product_sums": State(("product_id",), "orders"),
    "category_orders": State(("category",), "total_orders"),
    "delivery_months": State(("month",), "delivered"),
    "buyers": State(("customer_unique_id",), "frequency_orders", ("last_purchase_date",)),
    "last_day": State((), "orders", ("last_day",)),
}


def _wide(df: DataFrame) -> DataFrame:
    """Amounts and counts in types that sums of sums keep."""
    kinds = {f.name: "decimal(38,2)" if isinstance(f.dataType, DecimalType) else "bigint" for f in df.schema if isinstance(f.dataType, (DecimalType, IntegerType, LongType))}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def _added(state: State, df: DataFrame) -> DataFrame:
    """One row per key: sums added up, maxima of maxima; NULL only where no part has a value."""
    values = [c for c in df.columns if c not in state.keys]
    sums = [(F.max(c) if c in state.maxima else F.sum(c)).alias(c) for c in values]
    return _wide(df.groupBy(*state.keys).agg(*sums)).select(*df.columns)


class MartStates:
    """The stored sums of one star below ``folder``."""

    def __init__(self, spark: SparkSession, home: StarHome, folder: str):
        self.spark, self.home, self.folder = spark, home, folder

    def _covered(self) -> tuple[dict[str, set[str]], list[str]]:
        """(data files by table, parts) of the newest complete version."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path(self.folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        versions = f"{self.folder}/versions"
        names = sorted(s.getPath().getName() for s in files.listStatus(path(versions))) if files.exists(path(versions)) else []
        names = [name for name in names if files.exists(path(f"{versions}/{name}/_SUCCESS"))]
        covered: dict[str, set[str]] = {name: set() for name in STAR_SCHEMAS}
        if not names:
            return covered, []
        rows = self.spark.read.schema("kind STRING, name STRING").parquet(f"{versions}/{names[-1]}").collect()
        for row in rows:
            if row.kind != "part":
                covered[row.kind].add(row.name)
        return covered, sorted(row.name for row in rows if row.kind == "part")

    def _commit(self, files: dict[str, list[str]], parts: list[str]) -> None:
        rows = [(table, file_name(path)) for table, paths in files.items() for path in paths] + [("part", part) for part in parts]
        frame = self.spark.createDataFrame(rows, "kind STRING, name STRING").coalesce(1)
        writer = frame.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        writer.parquet(f"{self.folder}/versions/v{time.time_ns():020d}")

    def update(self) -> None:
        """Add what was loaded since the last update."""
        files = {table: table_files(self.spark, self.home, table) for table in STAR_SCHEMAS}
        covered, parts = self._covered()
        new = {table: [p for p in paths if file_name(p) not in covered[table]] for table, paths in files.items()}
        if parts and not any(new.values()):
            return
        part = f"p{time.time_ns():020d}"
        with state_changes(self._rows(files, new, covered)) as found:
            for name in STATES:
                _wide(found[name]).write.parquet(f"{self.folder}/parts/{part}/{name}")
        parts = [*parts, part]
        if len(parts) > MOST_PARTS:
            whole = f"p{time.time_ns():020d}"
            for name in STATES:
                self._read(name, parts).write.parquet(f"{self.folder}/parts/{whole}/{name}")
            parts = [whole]
        self._commit(files, parts)

    def _orders_touched(self, new: dict[str, list[str]]) -> DataFrame:
        ids = [read_files(self.spark, table, new[table]).select("order_id") for table in FACTS if new[table]]
        for dimension, key, fact in (("dim_customers", "customer_id", "fact_orders"), ("dim_products", "product_id", "fact_order_items")):
            if new[dimension]:
                keys = store(read_files(self.spark, dimension, new[dimension]).select(key).dropna())
                paths, _ = files_of_keys(self.spark, self.home, fact, keys, key)
                ids.append(read_files(self.spark, fact, paths).join(keys, key, "left_semi").select("order_id"))
        if not ids:
            return self.spark.createDataFrame([], "order_id STRING")
        return store(reduce(DataFrame.unionAll, ids).dropna().distinct())

    def _marked(self, table: str, paths: list[str], covered: dict[str, set[str]]) -> DataFrame:
        """The rows of some data files, each with whether it was known before."""
        known = [p for p in paths if file_name(p) in covered[table]]
        fresh = [p for p in paths if file_name(p) not in covered[table]]
        parts = [read_files(self.spark, table, some).withColumn(KNOWN, F.lit(mark)) for some, mark in ((known, True), (fresh, False)) if some]
        return reduce(DataFrame.unionAll, parts or [read_files(self.spark, table, []).withColumn(KNOWN, F.lit(False))])

    def _rows(self, files: dict[str, list[str]], new: dict[str, list[str]], covered: dict[str, set[str]]) -> StarSchema:
        """The rows an update needs: those of the touched orders, or all of them where that is less work."""
        if not any(covered.values()):
            star = read_star(self.spark, self.home)
            return StarSchema(**{table: df.withColumn(KNOWN, F.lit(False)) for table, df in star.tables().items()})
        # Counts are read from the footers.
        fresh, every = (sum(read_files(self.spark, table, some[table]).count() for table in FACTS if some[table]) for some in (new, files))
        if fresh * MANY_NEW < every:
            return self._touched_rows(new, covered)
        return StarSchema(**{table: self._marked(table, paths, covered) for table, paths in files.items()})

    def _touched_rows(self, new: dict[str, list[str]], covered: dict[str, set[str]]) -> StarSchema:
        """The star of the touched orders, its rows marked as :meth:`_marked` does."""
        orders = self._orders_touched(new)
        tables: dict[str, DataFrame] = {}

        def take(table: str, keys: DataFrame, key: str) -> None:
            paths = files_of_keys(self.spark, self.home, table, keys, key)[0]
            # Read more than once, so they are found once.
            tables[table] = store(self._marked(table, paths, covered).join(keys, key, "left_semi"))

        for table in FACTS:
            take(table, orders, "order_id")
        for dimension, key, fact in (("dim_customers", "customer_id", "fact_orders"), ("dim_products", "product_id", "fact_order_items")):
            take(dimension, store(tables[fact].select(key).dropna().distinct()), key)
        for table in ("dim_sellers", "dim_date"):
            tables[table] = self._marked(table, [], covered)
        return StarSchema(**tables)

    def _touched(self, new: dict[str, list[str]], covered: dict[str, set[str]]) -> tuple[StarSchema, StarSchema]:
        """The star of the touched orders, as known before and as it is now."""
        tables = self._touched_rows(new, covered).tables()
        before = {table: df.where(KNOWN).drop(KNOWN) for table, df in tables.items()}
        return StarSchema(**before), StarSchema(**{table: df.drop(KNOWN) for table, df in tables.items()})

    def _read(self, name: str, parts: list[str]) -> DataFrame:
        state = STATES[name]
        paths = [f"{self.folder}/parts/{part}/{name}" for part in parts]
        found = _added(state, self.spark.read.parquet(*paths))
        return found.where(F.col(state.rows) > 0)

    def read(self) -> dict[str, DataFrame]:
        """The sums of the newest complete version."""
        _, parts = self._covered()
        if not parts:
            raise FileNotFoundError(f"{self.folder} holds no sums; update first")
        return {name: self._read(name, parts) for name in STATES}

    def results(self, ref_date: date | None = None) -> dict[str, DataFrame]:
        """The five KPI tables from the stored sums."""
        sums = self.read()
        ref_day = F.lit(ref_date) if ref_date is not None else sums["last_day"].select(F.date_add("last_day", 1)).scalar()
        star = read_star(self.spark, self.home)
        return {
            "kpi_general": marts.kpi_general_of(sums["person_kpis"], sums["seller_products"]),
            "revenue_monthly": marts.revenue_monthly_of(sums["person_months"]),
            "top_categories": marts.top_categories_of(sums["product_sums"], sums["category_orders"], star),
            "delivery_performance": marts.delivery_performance_of(sums["delivery_months"]),
            "rfm_segments": marts.segments_of(rfm.scores_of(rfm.recency_of(sums["buyers"], ref_day))),
        }
