"""KPI results stored for dashboards."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ordersight.operators import marts
from ordersight.sources.mart_states import MartStates
from ordersight.sources.star_tables import StarHome
from ordersight.star import StarSchema

MARTS = [
    "kpi_general",
    "revenue_monthly",
    "top_categories",
    "delivery_performance",
    "rfm_segments",
]


KEPT_VERSIONS = 2


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Finished versions below ``folder``, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [name for name in _names(spark, folder) if files.exists(path(f"{folder}/{name}/_SUCCESS"))]


def publish_mart(df: DataFrame, root: str, name: str, database: str | None = None) -> str:
    """Store a new version of the result ``name``; results are small, so one file each.

    Readers keep the version before until the new one is complete. With ``database``
    the table ``mv_<name>`` there is pointed to the new version.
    """
    spark, folder = df.sparkSession, f"{root}/{name}"
    earlier = _versions(spark, folder)
    # What was begun before the newest finished version and never ended.
    broken = [name for name in _names(spark, folder) if earlier and name < earlier[-1] and name not in earlier]
    path = f"{folder}/v{time.time_ns():020d}"
    df.coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    if database:
        table = f"{database}.mv_{name}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    for old in [*earlier[: 1 - KEPT_VERSIONS], *broken]:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{old}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return path


def refresh_all(
    star: StarSchema, root: str, ref_date: date | None = None, database: str | None = None
) -> None:
    """Compute and store all five results.

    Payments are summed by order in each; stored once they would lose the buckets
    of the payment table, and every join by order would shuffle.
    """
    results = {
        "kpi_general": marts.kpi_general(star),
        "revenue_monthly": marts.revenue_monthly(star),
        "top_categories": marts.top_categories(star),
        "delivery_performance": marts.delivery_performance(star),
        "rfm_segments": marts.rfm_segments_mart(star, ref_date),
    }
    for name, df in results.items():
        publish_mart(df, root, name, database)


def refresh_changed(
    spark: SparkSession, home: StarHome, root: str, ref_date: date | None = None, database: str | None = None
) -> None:
    """As :func:`refresh_all` on the star at ``home``, from sums kept below ``root``.

    Only what was loaded since the last refresh is read, with the other rows of the orders
    it touches (:mod:`ordersight.sources.mart_states`).
    """
    states = MartStates(spark, home, f"{root}/_states")
    states.update()
    for name, df in states.results(ref_date).items():
        publish_mart(df, root, name, database)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The last complete version."""
    versions = _versions(spark, f"{root}/{name}")
    if not versions:
        raise FileNotFoundError(f"{root} holds no result {name}")
    return spark.read.parquet(f"{root}/{name}/{versions[-1]}")
